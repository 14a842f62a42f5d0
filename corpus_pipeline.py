"""A corpus pipeline: toxic documents go, then near duplicates, repeated
passages and documents with benchmark items; the rest is encoded.

Every stage takes all documents its predecessor kept, as Parquet, and returns
the columns of ``documents``, further ones of any name among them; the last
returns token ids. Rows are judged by their own text, also where ids repeat or
are null; null labels count for nothing. Texts of any length are taken whole. An
empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmill.llm import bpe, decontaminate, neardup, suffix_dedup, toxicity
from chatmill.llm.common import discard, staged, table
from chatmill.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects. A null or empty text
    scores as one without words; a score at the threshold goes; equal rows share their fate."""
    return toxicity.drop_toxic(docs, toxicity.fit_to(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are alike to 0.8:
    the one of smallest id (a null id is the smallest; of rows equal in id and
    text any one). Documents without words all stay."""
    return neardup.drop_near_duplicates(docs, size=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the passages of 50 bytes or more that a document of smaller id
    has (rows of one id count as one document, a null id as the largest). All
    documents stay, as an empty text if nothing else is left; a null text
    becomes the empty one. ``n_chars`` is the length of what is left."""
    return suffix_dedup.without_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that contain a benchmark item. A null or empty text
    contains none; items without words are in no document."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, exact (the ids decode to the text), a row each. A
    null or empty text has no ids and is exact."""
    rows = bpe.encode_decode(docs.select(F.struct("doc_id", F.sha2("text", 256).alias("sha")).alias("of"), "text"), vocabulary(), id_col="of")
    return rows.select("doc_id.doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       (F.sha2("decoded", 256) == F.coalesce("doc_id.sha", F.sha2(F.lit(""), 256))).alias("exact"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeats),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: The classifier and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, path = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            discard(spark, before)
        before = path
    return docs
