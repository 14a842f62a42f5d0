"""Salting hot join keys.

A key that holds a large share of the rows (one conversation with a third of
all turns, say) would put all of them in one task of a hash join, and AQE's
skew handling does not cover chained joins on the same key. So:

1. count rows per key on the big side (partial aggregation, two columns);
2. keep every key above ``hot_rows`` (there are at most rows / hot_rows of
   them), each with ``ceil(n / hot_rows)`` salts, as a staged table whose join
   Spark chooses by its size;
3. the big side's rows of a hot key get a salt from a hash of their own
   columns; the small sides replicate only the hot keys' rows, once per salt;
4. the joins run on (key, salt).

Non-hot keys keep salt 0 and are neither replicated nor split. With no hot
key at all, callers join on the key alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatmill.session import stage

SALT = "_salt"
HOT_ROWS = 100_000
NULL_SALTS = 1_024         # rows without a key match nothing; they are only spread


def hot_keys(counts_src: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """(key, _salts) for every hot key, computed once; None when no key is hot.
    A null key that is hot counts; ``salt_big`` spreads its rows, which match nothing."""
    n = F.count(F.lit(1)).alias("_n")
    hot = (counts_src.groupBy(key).agg(n).where(F.col("_n") > F.lit(hot_rows))
           .select(key, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_salts")))
    hot = counts_src.sparkSession.read.schema(hot.schema).parquet(stage(hot, "hot-keys"))
    return None if hot.isEmpty() else hot


def salt_big(df: DataFrame, hot: DataFrame, key: str, spread: Sequence[str]) -> DataFrame:
    """Rows of a hot key get ``pmod(hash(spread columns), salts)``; others 0."""
    x = df.join(hot, key, "left")
    spread_null = F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(NULL_SALTS)).cast("int")
    salt = F.when(F.col(key).isNull(), spread_null).when(F.col("_salts").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.col("_salts")).cast("int"))
    return x.withColumn(SALT, salt).drop("_salts")


def salt_small(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Hot keys' rows once per salt; other rows once, with salt 0."""
    x = df.join(hot, key, "left")
    return x.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))).drop("_salts")
