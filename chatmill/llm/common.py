"""Helpers shared by the operators: staging, cleaning up, range buckets."""

from __future__ import annotations

import importlib
import math
import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmill.session import stage

#: A null id sorts as this value, before every other id.
NULL_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column) -> Column:
    """The text, a null one as the empty string."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def staged(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet to the shared folder and read it back; it is
    deleted when the driver ends, or by ``discard``."""
    path = stage(df, label)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete staged tables that nothing reads any more."""
    jvm = spark._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def ship(*modules: str) -> None:
    """Pickle these modules by value into task closures, so that workers need
    no installed package."""
    from pyspark import cloudpickle
    for name in modules:
        cloudpickle.register_pickle_by_value(importlib.import_module(name))


def per_process(name: str, build):
    """What ``build()`` returned the first time in this worker process."""
    box = sys.modules.setdefault("_chatmill_llm_worker", types.ModuleType("_chatmill_llm_worker"))
    if not hasattr(box, name):
        setattr(box, name, build())
    return getattr(box, name)


def range_bounds(df: DataFrame, key: Column, rows_per_bucket: int, max_buckets: int = 10_000) -> list[int]:
    """Ascending upper bounds of ranges of a long key; the last is its maximum.

    Reads the key column only. One long a bucket reaches the driver, at most
    ``max_buckets``. Empty input gives an empty list.
    """
    n = df.count()
    if not n:
        return []
    buckets = max(1, min(max_buckets, math.ceil(n / rows_per_bucket)))
    cuts = F.percentile_approx(key, [i / buckets for i in range(1, buckets)] or [1.0], max(10_000, 10 * buckets))
    mids, top = df.agg(cuts, F.max(key)).first()
    return sorted({*(mids if buckets > 1 else []), top})


def bucket_of(key: Column, bounds: list[int]) -> Column:
    """How many of ``bounds`` lie below ``key``: a binary search as a fold over
    descending powers of two, on a constant array."""
    if len(bounds) < 2:
        return F.lit(0)
    array = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda at, s: F.when((at + s <= len(bounds)) & (F.get(array, at + s - 1) < key), at + s).otherwise(at))


def check_threshold(value: float) -> float:
    if not 0 < value <= 1:
        raise ValueError("a threshold lies in (0, 1]")
    return value
