"""Cross-tokenizer alignment of whole documents; the method is in ``token_alignment``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_model, token_alignment
from .bpe import MAX_FILE_BYTES, vocabulary_file
from .common import discard, per_process, ship, staged

#: Pairs of at least one link in so many are broadcast: there are no more of them than that.
HOT_PAIRS = 1 << 18


def align_tokenizers(docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_links, groups, pairs: both encodings of space+text,
    cut at the byte offsets where a token of each ends.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``, the ids of each group; ``pairs`` has
    for every link A's id, shifted by ``B_BITS``, or B's id. A null or empty
    text, and one whose tokens of A or B do not join to its bytes, has no
    tokens. Rows stay as they are, repeated or with a null id; other columns are
    not read. One narrow pass; a task holds some texts at a time.
    """
    ship(bpe_model.__name__, token_alignment.__name__)
    spark = docs.sparkSession
    with open(b_file, "rb") as f:
        model = f.read(MAX_FILE_BYTES + 1)
    if len(model) > MAX_FILE_BYTES:
        raise ValueError(f"{b_file} is larger than {MAX_FILE_BYTES} bytes")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    mapped = rows.mapInArrow(token_alignment.aligner(vocabulary_file(spark, a_file), spark.sparkContext.broadcast(model), per_process),
                             f"id {id_type}, n_a long, n_b long, n_links long, groups string, pairs array<bigint>")
    return mapped.withColumnRenamed("id", "doc_id")


def score_links(aligned: DataFrame) -> DataFrame:
    """The rows of ``aligned`` without pairs, with count_sum (over its links,
    how many links of all documents hold the same pair) and n_best (links whose
    count is the highest of their B id; ties count).

    Pairs that hold at least one link in ``HOT_PAIRS`` are at most that many and
    are broadcast, so no frequent pair is shuffled; the others, summed up by
    document, meet their counts in a join that no key can dominate.
    """
    ship(token_alignment.__name__)
    spark = aligned.sparkSession
    docs, docs_path = staged(aligned.withColumn("key", F.monotonically_increasing_id()), "aligned")
    counts, counts_path = staged(docs.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << token_alignment.B_BITS) - 1))
    top = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))
    scored, scored_path = staged(counts.withColumn("b", b_id).join(top, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-scores")
    discard(spark, counts_path)
    least = max(1, -(-(scored.agg(F.sum("n")).first()[0] or 0) // HOT_PAIRS))
    hot = scored.where(F.col("n") >= least).orderBy("pair").toArrow()
    known, n, best = (spark.sparkContext.broadcast(hot.column(c).to_numpy()) for c in ("pair", "n", "best"))
    links = docs.select("key", "pairs")
    cold = (links.mapInArrow(token_alignment.others(known), "key long, pair long, times long")
            .join(scored.where(F.col("n") < least), "pair").groupBy("key")
            .agg(F.sum(F.col("times") * F.col("n")).alias("sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best")))
    sums = links.mapInArrow(token_alignment.scorer(known, n, best), "key long, hot_sum long, hot_best long")
    if least > 1:
        sums = sums.unionByName(cold.select("key", F.col("sum").alias("hot_sum"), F.col("best").alias("hot_best"))).groupBy("key").agg(
            F.sum("hot_sum").alias("hot_sum"), F.sum("hot_best").alias("hot_best"))
    rest = docs.drop("pairs")
    return rest.join(sums, "key").select(*(c for c in rest.columns if c != "key"), F.col("hot_best").alias("n_best"), F.col("hot_sum").alias("count_sum"))
