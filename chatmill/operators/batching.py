"""Batch collation as a Spark job.

Rows are batched by ordinal (``batch_id = ordinal div batch_size``); each
batch is padded to its longest row, rounded up to ``pad_multiple``: ids with
the pad id, the mask with 0, labels with -100, right side only.

Consecutive rows lie together in a scan, so nearly every batch is whole in one
task and is padded as it passes: no token array is moved. A first pass over the
ordinals and lengths alone finds the batches that the edge of a file or split
cuts, and their widths; these few rows (two a task at most, where no rows were
dropped) are looked up in the second pass. Where more are cut than a broadcast
should carry, rows meet their width in a join instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.config import IGNORE_INDEX
from chatmill.functions.arrays import pad_right
from chatmill.operators import pad_tasks
from chatmill.operators.ordinal import with_ordinal
from chatmill.session import ship_package, stage

#: Cut batches (12 bytes each) up to which their widths are broadcast.
MAX_BROADCAST_EDGES = 1_000_000


def _length(df: DataFrame):
    return F.col("n_ids") if "n_ids" in df.columns else F.size("input_ids")


def batch_widths(df: DataFrame, batch_size: int, ordinal: str = "ordinal") -> DataFrame:
    """A4: adds ``batch_id`` and ``width`` (longest row of the batch), by a
    grouped maximum that is joined back; rows may lie anywhere."""
    _check(batch_size)
    if ordinal not in df.columns:
        df = with_ordinal(df, ordinal)
    x = df.withColumn("batch_id", F.floor(F.col(ordinal) / F.lit(batch_size)).cast("long"))
    widths = x.select("batch_id", _length(x).alias("n")).groupBy("batch_id").agg(F.max("n").cast("int").alias("width"))
    return x.join(widths, "batch_id")


def _check(batch_size: int) -> None:
    if batch_size < 1:
        raise ValueError("batch_size must be >= 1")


def cut_batches(df: DataFrame, batch_size: int, ordinal: str = "ordinal") -> DataFrame:
    """(batch_id, width) of the batches that no task of this scan holds whole, the last one among them."""
    ship_package(df.sparkSession)
    found = df.select(F.col(ordinal).cast("long"), F.greatest(_length(df), F.lit(0)).cast("int").alias("n")).mapInArrow(
        pad_tasks.edge_finder(batch_size), "batch_id long, width int")
    return found.groupBy("batch_id").agg(F.max("width").alias("edge"))


def pad_batches(df: DataFrame, batch_size: int, pad_id: int, pad_multiple: int | None = None,
                ordinal: str = "ordinal", keep=()) -> DataFrame:
    """Rectangular batches, one row per example (D9), in scan order. The
    attention mask is 1 for every id, so it is rebuilt rather than read."""
    _check(batch_size)
    if ordinal not in df.columns:
        df = with_ordinal(df, ordinal)
    edges = df.sparkSession.read.schema("batch_id long, edge int").parquet(stage(cut_batches(df, batch_size, ordinal), "edges"))
    if edges.count() > MAX_BROADCAST_EDGES:
        return _pad_by_join(df, batch_size, pad_id, pad_multiple, ordinal, keep)
    x = df.select(*keep, F.col(ordinal).cast("long").alias(ordinal), "input_ids", "labels",
                  F.floor(F.col(ordinal) / F.lit(batch_size)).cast("long").alias("batch_id"))
    x = x.join(F.broadcast(edges), "batch_id", "left").select(*keep, ordinal, "input_ids", "labels", "edge")
    long_arr = T.ArrayType(T.LongType())
    out = T.StructType([x.schema[c] for c in (*keep, ordinal)] + [T.StructField("batch_id", T.LongType()), T.StructField("width", T.IntegerType())]
                       + [T.StructField(c, long_arr) for c in ("input_ids", "attention_mask", "labels")])
    return x.mapInArrow(pad_tasks.padder(batch_size, pad_id, IGNORE_INDEX, pad_multiple or 1, len(keep)), out)


def _pad_by_join(df: DataFrame, batch_size: int, pad_id: int, pad_multiple: int | None, ordinal: str, keep) -> DataFrame:
    cols = [*keep, ordinal, "input_ids", "labels", *[c for c in ("n_ids",) if c in df.columns]]
    x = batch_widths(df.select(*cols), batch_size, ordinal)
    width = F.col("width")
    if pad_multiple:
        width = (F.ceil(width / F.lit(pad_multiple)) * F.lit(pad_multiple)).cast("int")
    x = x.withColumn("width", width).withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))
    long_arr = "array<bigint>"
    return x.select(
        *keep, ordinal, "batch_id", "width",
        pad_right("input_ids", "width", pad_id).cast(long_arr).alias("input_ids"),
        pad_right("attention_mask", "width", 0).cast(long_arr).alias("attention_mask"),
        pad_right("labels", "width", IGNORE_INDEX).cast(long_arr).alias("labels"))
