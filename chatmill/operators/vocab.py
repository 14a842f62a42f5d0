"""A fitted vocabulary and encoding against it.

The reference loads a fixed vocabulary; this is the Spark job that builds
one from a token column. Specials take ids 0..7 in registration order; the
other tokens are ranked by (count desc, token asc) and the top
``vocab_size - 8`` kept, so the table has a proven upper bound and can be
broadcast when encoding. Out-of-vocabulary tokens map to ``unk_id``.
Encoding is a narrow Arrow map over each partition (no token shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.config import SPECIAL_TOKENS
from chatmill.session import ship_package, shared_dir

DEFAULT_VOCAB_SIZE = 1 << 16


def token_counts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Occurrences per token (partial aggregation map-side: a frequent token
    is combined inside each task before the shuffle)."""
    return df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("count"))


_FANOUT = 4096


def count_threshold(counts: DataFrame, k: int) -> int:
    """The k-th largest ``count`` (or 1 when there are fewer than k rows).

    A log2 histogram of counts (<= 64 rows) finds the range [2^b, 2^(b+1))
    holding the k-th value. That range is then cut into at most 4,096
    equal-width sub-ranges per pass until it is a single value, so no pass
    returns more than 4,096 rows. Rows below the threshold can never reach
    the top k, so the final top-k merge only sees ``k + ties`` candidates
    instead of ``k`` from every partition.
    """
    c = F.col("count")
    hist = sorted(((r[0], r[1]) for r in counts.groupBy(F.floor(F.log2(c)).cast("int").alias("b"))
                   .agg(F.count(F.lit(1))).collect()), reverse=True)
    above = 0                              # rows known to lie above the current range
    for b, n in hist:
        if above + n >= k:
            lo, hi = 1 << b, 1 << (b + 1)
            break
        above += n
    else:
        return 1
    while hi - lo > 1:
        width = -(-(hi - lo) // _FANOUT)
        scope = counts.where((c >= lo) & (c < hi))
        sub = sorted(((r[0], r[1]) for r in scope.groupBy(F.floor((c - F.lit(lo)) / F.lit(width)).cast("long").alias("s"))
                      .agg(F.count(F.lit(1))).collect()), reverse=True)
        for s_, n in sub:
            if above + n >= k:
                lo, hi = lo + s_ * width, min(hi, lo + (s_ + 1) * width)
                break
            above += n
    return int(lo)


def fit_vocab(df: DataFrame, tokens: str = "tokens", vocab_size: int = DEFAULT_VOCAB_SIZE,
              specials=SPECIAL_TOKENS) -> DataFrame:
    """(token STRING, id INT, count BIGINT), at most ``vocab_size`` rows.

    One aggregation (staged once); present specials first, then the most
    frequent tokens by (count desc, token asc). Ids are assigned on the
    bounded table only.
    """
    n_special = len(specials)
    if vocab_size <= n_special:
        raise ValueError("vocab_size must exceed the number of special tokens")
    special_ids = F.create_map(*[x for i, s in enumerate(specials) for x in (F.lit(s), F.lit(i))])
    shared_dir(df.sparkSession)        # counts are read by three passes: cut the lineage once
    counts = token_counts(df, tokens).withColumn("_sid", special_ids[F.col("token")]).checkpoint(eager=True)
    floor_count = count_threshold(counts.where(F.col("_sid").isNull()), vocab_size - n_special)
    order = [F.col("_sid").asc_nulls_last(), F.desc("count"), F.asc("token")]
    top = (counts.where(F.col("_sid").isNotNull() | (F.col("count") >= F.lit(floor_count)))
           .orderBy(*order).limit(vocab_size))
    rank = F.row_number().over(Window.partitionBy(F.col("_sid").isNull()).orderBy(*order))
    ranked = top.withColumn("_rank", rank)
    vid = F.coalesce(F.col("_sid"), F.col("_rank") + F.lit(n_special - 1)).cast("int")
    return (ranked.where(F.col("_sid").isNotNull() | (F.col("_rank") <= F.lit(vocab_size - n_special)))
            .select("token", vid.alias("id"), "count"))


#: Tokens that are looked up at a time.
HELD_TOKENS = 1 << 18


def _lookup_fn(vocab_bc, tokens: str, name: str, unk_id: int, held: int = HELD_TOKENS):
    def fn(it):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        known = pa.array(vocab_bc.value[0], pa.string())
        ids_of = pa.array(vocab_bc.value[1], pa.int32())
        for whole in it:
            at = whole.schema.get_field_index(tokens)
            ends = np.cumsum(pc.list_value_length(whole.column(at)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            begin = 0
            while begin < whole.num_rows:
                # rows of bounded tokens together, one at least; strings stay in Arrow, as no Python objects
                done = int(ends[begin - 1]) if begin else 0
                end = max(begin + 1, int(np.searchsorted(ends, done + held, "right")))
                rb = whole.slice(begin, end - begin)
                flat = pc.list_flatten(rb.column(at))
                if not pa.types.is_string(flat.type):
                    flat = flat.cast(pa.string())
                ids = ids_of.take(pc.index_in(flat, value_set=known)).fill_null(unk_id)
                arr = pa.ListArray.from_arrays(pa.array(np.r_[0, ends[begin:end] - done].astype(np.int32)), ids)
                cols = [rb.column(j) for j in range(rb.num_columns) if j != at]
                names = [f.name for j, f in enumerate(rb.schema) if j != at]
                yield pa.RecordBatch.from_arrays(cols + [arr], names=names + [name])
                begin = end
    return fn


def encode_with_vocab(df: DataFrame, vocab: DataFrame, tokens: str = "tokens", name: str = "input_ids",
                      unk_id: int = -1, max_vocab: int = DEFAULT_VOCAB_SIZE) -> DataFrame:
    """Token lists -> ids through the vocabulary, as a narrow map.

    The vocabulary's size is checked against ``max_vocab`` and then shipped
    once as a broadcast variable; each Arrow batch is flattened and looked up
    through a hash index in vectorised calls of bounded size. Unlike explode -> join ->
    regroup, this moves no token data between tasks.
    """
    rows = vocab.select("token", "id").limit(max_vocab + 1).collect()
    if len(rows) > max_vocab:
        raise ValueError(f"vocabulary larger than max_vocab={max_vocab}; raise the bound explicitly")
    spark = df.sparkSession
    ship_package(spark)
    bc = spark.sparkContext.broadcast(([r[0] for r in rows], [int(r[1]) for r in rows]))
    fields = [f for f in df.schema.fields if f.name != tokens]
    out = T.StructType(fields + [T.StructField(name, T.ArrayType(T.IntegerType(), containsNull=False), True)])
    return df.mapInArrow(_lookup_fn(bc, tokens, name, unk_id), out)
