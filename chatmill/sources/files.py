"""File scans with declared schemas and the split-source choice."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from chatmill.operators.ordinal import scan_with_position
from chatmill.sources.schemas import RECORD, TOKENIZED, TOKENIZED_ORIGIN


def scan_jsonl(spark: SparkSession, path: str, positioned: bool = True) -> DataFrame:
    """instruction/output JSONL (file or directory of parts), no inference.
    ``positioned`` keeps file/split columns so ordinals and caps work."""
    if positioned:
        return scan_with_position(spark, path, "json", RECORD)
    return spark.read.schema(RECORD).json(path)


def tokenized_schema(spark: SparkSession, path: str) -> StructType:
    """D7, and where its rows came from, as far as the folder tells."""
    have = set(spark.read.parquet(path).columns)
    return StructType(TOKENIZED.fields + [f for f in TOKENIZED_ORIGIN.fields if f.name in have])


def scan_tokenized(spark: SparkSession, path: str, positioned: bool = True) -> DataFrame:
    """Pre-tokenized Parquet directory."""
    if positioned:
        return scan_with_position(spark, path, "parquet", tokenized_schema(spark, path))
    return spark.read.schema(TOKENIZED).parquet(path)


def try_scan(fn, spark: SparkSession, path: str | None, **kw) -> DataFrame | None:
    """``fn(spark, path)`` or None when the path is unset or missing."""
    if not path:
        return None
    try:
        df = fn(spark, path, **kw)
        df.schema  # resolves the file listing
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def resolve_split(spark: SparkSession, tokenized_dir: str | None, raw_file: str | None,
                  encode_raw=None) -> tuple[str, DataFrame] | None:
    """Prefer an existing tokenized directory, else an existing raw JSONL
    file run through ``encode_raw``; None when neither exists."""
    tok = try_scan(scan_tokenized, spark, tokenized_dir)
    if tok is not None:
        return "tokenized", tok
    raw = try_scan(scan_jsonl, spark, raw_file)
    if raw is not None:
        return "raw", (encode_raw(raw) if encode_raw is not None else raw)
    return None
