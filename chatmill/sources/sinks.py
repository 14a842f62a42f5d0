"""JSONL, Parquet and metadata writers with an explicit save mode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SAVE_MODES = ("errorifexists", "overwrite")


def save_mode(overwrite: bool) -> str:
    """Refuse to write into an existing output unless overwrite is set."""
    return "overwrite" if overwrite else "errorifexists"


def _ordered(df: DataFrame, order_by, partitions: int | None) -> DataFrame:
    """Range partitions in key order. Without an explicit count, AQE may merge
    adjacent ranges to its advisory size, which keeps the order and sizes the
    output files to the data."""
    if not order_by:
        return df
    parts = df.repartitionByRange(int(partitions), *order_by) if partitions else df.repartitionByRange(*order_by)
    return parts.sortWithinPartitions(*order_by)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", order_by=None,
                partitions: int | None = None) -> None:
    """One JSON object per line, UTF-8 with non-ASCII unescaped; a
    directory of part files. ``order_by`` writes in that global order
    (range-partitioned, sorted within parts, parts in name order)."""
    out = _ordered(df, order_by, partitions).select("instruction", "output")
    out.write.mode(mode).option("ignoreNullFields", "false").json(path)


def refuse_existing(spark: SparkSession, paths: list[str], overwrite: bool) -> None:
    """W4, before any work starts: raise if an output exists and may not be replaced."""
    if overwrite:
        return
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            raise FileExistsError(f"{path} exists; pass overwrite=True to replace it")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def write_tokenized(df: DataFrame, path: str, mode: str = "overwrite", extra: tuple[str, ...] = ()) -> None:
    """``<out>/<split>_tokenized`` as Parquet, with ``extra`` columns."""
    df.select("input_ids", "attention_mask", "labels", *extra).write.mode(mode).parquet(path)


def write_metadata(meta: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The one-row run metadata as JSON."""
    meta.coalesce(1).write.mode(mode).json(path)
