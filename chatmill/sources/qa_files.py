"""Readers of the three QA corpora as JSON-lines or Parquet files.

Every row gets its source and a key, its position in the files, which is also
what the per-source cap counts. The polymorphic fields of the evidence corpus
are kept as raw JSON text in JSON files, whatever their shape, and as the nested
type that the files declare in Parquet (``operators.context`` reads either).

With a ``cap``, only the files up to the cap are opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chatmill.operators.ordinal import prefix_cap, scan_prefix, scan_with_position, with_ordinal
from chatmill.sources.schemas import CONTEXT_FIELDS, EVIDENCE_QA, SPAN_QA, SPAN_QA_V2


def _read(spark: SparkSession, path: str, fmt: str, schema: StructType, source: str, cap: int | None) -> DataFrame:
    if cap is not None and fmt != "parquet":
        rows = scan_prefix(spark, path, cap, fmt, schema)
    else:
        rows = scan_with_position(spark, path, fmt, schema)
        rows = with_ordinal(rows) if cap is None else prefix_cap(with_ordinal(rows), cap)
    return rows.select(F.lit(source).alias("source"), F.concat_ws(":", F.lit(source), F.col("ordinal").cast("string")).alias("rec_key"),
                       "ordinal", *schema.fieldNames())


def read_span_qa(spark: SparkSession, path: str, fmt: str = "json", cap: int | None = None) -> DataFrame:
    """Question, context, answers.text."""
    return _read(spark, path, fmt, SPAN_QA, "squad", cap)


def read_span_qa_v2(spark: SparkSession, path: str, fmt: str = "json", cap: int | None = None) -> DataFrame:
    """D1 and is_impossible."""
    return _read(spark, path, fmt, SPAN_QA_V2, "squad_v2", cap)


def evidence_schema(spark: SparkSession, path: str, fmt: str) -> StructType:
    """D3 with the context fields as the files declare them. Only files that
    carry a schema are asked; a field that they lack is null text."""
    if fmt != "parquet":
        return EVIDENCE_QA
    have = {f.name: f for f in spark.read.parquet(path).schema.fields}
    return StructType([have.get(f.name, f) if f.name in CONTEXT_FIELDS else f for f in EVIDENCE_QA.fields])


def read_evidence_qa(spark: SparkSession, path: str, fmt: str = "json", cap: int | None = None) -> DataFrame:
    """S3: question, answer.value and three fields of any JSON shape or nested type (D3)."""
    return _read(spark, path, fmt, evidence_schema(spark, path, fmt), "trivia_qa", cap)


READERS = {"squad": read_span_qa, "squad_v2": read_span_qa_v2, "trivia_qa": read_evidence_qa}


def write_evidence_qa(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """D3 rows as JSON lines, the raw JSON fields nested as they are."""
    head = F.regexp_replace(F.to_json(F.struct("question", "answer"), {"ignoreNullFields": "false"}), r"\}$", "")
    nested = [F.concat(F.lit(f',"{c}":'), F.coalesce(F.col(c), F.lit("null"))) for c in ("entity_pages", "evidence", "search_results")]
    df.select(F.concat(head, *nested, F.lit("}")).alias("value")).write.mode(mode).text(path)
