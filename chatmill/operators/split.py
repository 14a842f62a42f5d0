"""Seeded hash order, exact-size split, counts, preview.

The reference shuffles an in-memory list and takes the first
``int(n * val_fraction)`` records as validation. Here the shuffle order is a
seeded hash: ``h = 60 bits of md5(seed ':' rec_key)``, ties broken by
``rec_key``. The split needs only the (h, rec_key) of the ``n_val``-th
smallest row, found by radix selection, 12 bits a pass (at most 4,096 counts
reach the driver in each):

* pass 1 counts rows by the top 12 bits (a null key is a bucket of its own,
  the first) and picks the bucket that holds the cutoff;
* each further pass counts only that bucket's rows by the next 12 bits, until
  it is small enough to look at its keys one by one;
* if only some rows of the cutoff's key are to be taken, the selection goes on
  in the same way through the bits of a hash of the whole row;
* rows that are equal in all columns are taken by their place in the staged
  files, with a literal condition.

No step sorts the data globally, routes a key through one partition, or walks
its rows on the driver; each pass reads just ``h`` (and the rows of one key at
the end). Labeling is a narrow projection, so the result does not depend on
the partition count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmill.config import DEFAULT_SEED, DEFAULT_VAL_FRACTION, PREVIEW_INSTRUCTION_CHARS, PREVIEW_OUTPUT_CHARS
from chatmill.operators.ordinal import SRC_BLOCK, SRC_FILE, SRC_ROW, cap_condition, scan_with_position
from chatmill.session import stage

HASH = "shuffle_key"
_BITS, _LEVEL = 60, 12
#: Keys, or hashes of rows, that are looked at one by one.
_EXACT_LIMIT = 4_096


def shuffle_key(seed: int = DEFAULT_SEED, key: str = "rec_key") -> Column:
    """BIGINT in [0, 2^60): 15 hex digits of ``md5(seed || ':' || key)``."""
    digest = F.md5(F.concat(F.lit(f"{int(seed)}:"), F.col(key)))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def seeded_shuffle(df: DataFrame, seed: int = DEFAULT_SEED, key: str = "rec_key") -> DataFrame:
    """O1: attach the seeded shuffle key; order is (shuffle_key, key)."""
    return df.withColumn(HASH, shuffle_key(seed, key))


def val_count(n_total: int, val_fraction: float) -> int:
    """``int(n * val_fraction)`` with Python doubles, as the reference."""
    if not (0.0 <= val_fraction < 1.0):
        raise ValueError(f"val_fraction must be in [0, 1), got {val_fraction}")
    return int(n_total * val_fraction)


TIE = "_tie"
_PLACE = (SRC_FILE, SRC_BLOCK, SRC_ROW)


def _with_tie(df: DataFrame, key: str) -> DataFrame:
    """Rows of one key are told apart by a hash of their other columns."""
    rest = [c for c in df.columns if c not in (HASH, key, TIE, *_PLACE)]
    return df.withColumn(TIE, F.md5(F.to_json(F.struct(*rest), {"ignoreNullFields": "false"})) if rest else F.md5(F.lit("")))


def _radix(rows: DataFrame, digits: list[Column], rest: int, limit: int, hist=None) -> tuple[DataFrame, int, int]:
    """Narrow ``rows`` by one digit after the other to those that share the
    leading digits of the ``rest``-th smallest, until there are few or no more
    digits. Returns them, how many, and which of them it is. Null digits first."""
    n = None
    for digit in digits:
        counts = hist if hist is not None else _histogram(rows, digit)
        hist = None
        for value, n in counts:
            if rest <= n:
                break
            rest -= n
        else:
            raise RuntimeError("the rows changed between two passes: stage them first")
        rows = rows.where(digit.eqNullSafe(F.lit(value)))
        if n <= limit or value is None:
            break
    return rows, n, rest


def _histogram(rows: DataFrame, digit: Column) -> list[tuple[int | None, int]]:
    """Row counts by a 12-bit digit (<= 4096 rows and one of null reach the driver)."""
    counts = rows.groupBy(digit.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    return sorted(((r[0], r[1]) for r in counts), key=lambda c: (c[0] is not None, c[0] or 0))


def _digits(number: Column, bits: int = _BITS) -> list[Column]:
    return [F.shiftright(number, shift).bitwiseAND(F.lit((1 << _LEVEL) - 1)) for shift in range(bits - _LEVEL, -1, -_LEVEL)]


def _walk(rows: DataFrame, by: list[str], rest: int) -> tuple:
    """The group that holds the ``rest``-th row in order of ``by``, its size,
    and which row of it that is; ``_EXACT_LIMIT`` groups at a time."""
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    order: list[Column] = [F.col(c).asc_nulls_first() for c in by]
    after = None
    while True:
        page = (counts.where(after) if after is not None else counts).orderBy(*order).limit(_EXACT_LIMIT).collect()
        if not page:
            raise RuntimeError("the rows changed between two passes: stage them first")
        for r in page:
            if rest <= r["n"]:
                return (*(r[c] for c in by), r["n"], rest)
            rest -= r["n"]
        last = page[-1]
        after = F.lit(False)
        for i, c in enumerate(by):                      # (by) > last, a null being the least
            same = F.lit(True)
            for d in by[:i]:
                same = same & F.col(d).eqNullSafe(F.lit(last[d]))
            greater = F.col(c).isNotNull() if last[c] is None else F.coalesce(F.col(c) > F.lit(last[c]), F.lit(False))
            after = after | (same & greater)


def find_cutoff(df: DataFrame, val_fraction: float, key: str = "rec_key") -> tuple[int, tuple | None]:
    """(n_total, cutoff): the row count and the (shuffle_key, key) of the
    ``int(n * val_fraction)``-th smallest row (None when that is 0); both are
    null if its key is. If only some rows of the key are among them,
    (shuffle_key, key, tie, copies): of the rows with that hash of all columns,
    ``copies`` are taken. The first pass also yields the row count."""
    rows = df.select(HASH, key)
    digits = _digits(F.col(HASH))
    hist = _histogram(rows, digits[0])
    n_total = sum(n for _, n in hist)
    n_val = val_count(n_total, val_fraction)
    if n_val <= 0:
        return n_total, None
    scope, _, rest = _radix(rows, digits, n_val, _EXACT_LIMIT, hist)
    h, k, n, rest = _walk(scope, [HASH, key], rest)
    if rest == n:
        return n_total, (h, k)
    same = _with_tie(df.where(F.col(HASH).eqNullSafe(F.lit(h)) & F.col(key).eqNullSafe(F.lit(k))), key).select(TIE)
    ties = [F.conv(F.substring(TIE, at, 15), 16, 10).cast("long") for at in (1, 16)]
    scope, _, rest = _radix(same, [d for t in ties for d in _digits(t)], rest, _EXACT_LIMIT)
    tie, _, rest = _walk(scope, [TIE], rest)
    return n_total, (h, k, tie, int(rest))


def label_split(df: DataFrame, cutoff: tuple | None, key: str = "rec_key") -> DataFrame:
    """Add ``split`` = 'val' for rows at or before the cutoff, else 'train': a
    narrow projection. Only where a part of the cutoff's key is taken, its rows
    are told apart; ``df`` is a positioned scan then (``label_staged``)."""
    if cutoff is None:
        return df.withColumn("split", F.lit("train"))
    h, k = cutoff[:2]
    at = F.col(HASH).eqNullSafe(F.lit(h)) & F.col(key).eqNullSafe(F.lit(k))
    before = F.lit(False) if h is None else F.col(HASH).isNull() | (F.col(HASH) < F.lit(h)) | ((F.col(HASH) == F.lit(h)) & (
        (F.col(key) < F.lit(k)) if k is not None else F.lit(False)))
    named = lambda val: F.when(F.coalesce(val, F.lit(False)), F.lit("val")).otherwise(F.lit("train"))
    if len(cutoff) == 2:
        return df.withColumn("split", named(before | at))
    tie, copies = cutoff[2:]
    told = _with_tie(df, key)
    equal = told.where(at & (F.col(TIE) == F.lit(tie)))
    some = (F.col(TIE) < F.lit(tie)) | ((F.col(TIE) == F.lit(tie)) & cap_condition(equal, copies))
    return told.withColumn("split", named(before | (at & some))).drop(TIE, *_PLACE)


def label_staged(spark: SparkSession, path: str, cutoff: tuple | None, key: str = "rec_key") -> DataFrame:
    """``label_split`` over a staged table; its rows' places are read only where they count."""
    return label_split(scan_with_position(spark, path) if cutoff and len(cutoff) > 2 else spark.read.parquet(path), cutoff, key)


def exact_split(df: DataFrame, val_fraction: float = DEFAULT_VAL_FRACTION, seed: int = DEFAULT_SEED,
                key: str = "rec_key") -> DataFrame:
    """O2: exactly ``int(n * val_fraction)`` rows labeled 'val', the first in
    shuffle order; the rest 'train'. The rows are staged once; the counting
    passes and the result read that copy."""
    if HASH not in df.columns:
        df = seeded_shuffle(df, seed, key)
    path = stage(df, "split")
    _, cutoff = find_cutoff(df.sparkSession.read.schema(df.schema).parquet(path), val_fraction, key)
    return label_staged(df.sparkSession, path, cutoff, key)


def split_counts(df: DataFrame) -> DataFrame:
    """A1: one row (num_total, num_train, num_val)."""
    return df.agg(F.count(F.lit(1)).alias("num_total"),
                  F.count_if(F.col("split") == "train").alias("num_train"),
                  F.count_if(F.col("split") == "val").alias("num_val"))


def preview(df: DataFrame, key: str = "rec_key") -> DataFrame:
    """The first record of each non-empty split in shuffle order,
    instruction cut to 500 and output to 300 characters."""
    first = df.groupBy("split").agg(
        F.min_by(F.struct("instruction", "output"), F.struct(HASH, key)).alias("r"))
    return first.select(
        "split",
        F.substring("r.instruction", 1, PREVIEW_INSTRUCTION_CHARS).alias("instruction"),
        F.substring("r.output", 1, PREVIEW_OUTPUT_CHARS).alias("output"))
