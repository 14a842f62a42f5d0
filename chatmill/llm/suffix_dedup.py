"""Removal of substrings that an earlier document holds, by a common-prefix-
aware distributed merge sort of suffixes.

1. Documents are dealt once into chunks of bounded size, a bucketed table that
   the later steps read without shuffling texts again.
2. Every chunk announces the hashes of its anchors (see ``suffix_runs``); those
   that no other document announced cannot start a repeat. No repeat is lost:
   equal windows have equal anchors.
3. Every chunk sorts the suffixes at the shared anchors into a run, merges
   equal ones, and sends it front-coded, by ranges of the suffixes. A loser
   tree merges the runs of a range. Neighbours that share an anchor's gram are
   compared for windows that a document of smaller id holds.
4. The answers go back to the chunks, which remove what the windows cover.

A substring that a third of all documents share is one entry of each chunk; with
different surroundings it would be one of each document, all in one range. So
the windows at grams of more than ``HOT_ANCHORS`` anchors skip the merge: their
hashes, each with the smallest id of a chunk, meet by ranges of the hashes.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmill.session import delete_at_exit, scratch_path

from . import suffix_runs
from .common import discard, ship, staged, text_of

#: Bytes of text in a chunk, and chunks in a bucket of the table.
CHUNK_BYTES, CHUNKS_PER_BUCKET = 4 << 20, 8
#: Documents and grams of each that are drawn to part the suffixes into ranges; they set the balance only.
SAMPLE_DOCS, SAMPLE_GRAMS = 2_000, 16
#: Anchors that one gram's entries in a range come from at most.
HOT_ANCHORS = 8_192
#: A null id: above all others, so it never makes another document lose bytes.
_LAST_ID = 2**63 - 1


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    spark, name = df.sparkSession, f"chatmill_{uuid.uuid4().hex[:12]}"
    path = scratch_path(spark, "chunks")
    (df.repartition(buckets, key).sortWithinPartitions(key).write.bucketBy(buckets, key).sortBy(key)
     .option("path", path).option("compression", "zstd").saveAsTable(name, format="parquet"))
    delete_at_exit(spark, path)
    return spark.table(name)


def _chunk_of(chunks: int) -> Column:
    """Rows that share an id, or have none, are dealt by their texts too."""
    return F.pmod(F.xxhash64("id", "text"), F.lit(chunks)).cast("long")


def _splitters(docs: DataFrame, n_docs: int, ranges: int) -> list[bytes]:
    every = max(1, n_docs // SAMPLE_DOCS)
    raw = F.col("text").cast("binary")
    drawn = docs.where(F.pmod(F.xxhash64("id", "text", F.lit(10)), F.lit(every)) == 0).select(F.explode(F.transform(
        F.sequence(F.lit(1), F.lit(SAMPLE_GRAMS)),
        lambda i: F.substring(raw, (F.pmod(F.xxhash64("id", i), F.greatest(F.octet_length("text"), F.lit(1))) + 1).cast("int"), F.lit(suffix_runs.GRAM)))).alias("g"))
    grams = sorted(bytes(r["g"]) for r in drawn.limit(2 * SAMPLE_DOCS * SAMPLE_GRAMS).collect() if r["g"])
    return sorted({grams[len(grams) * i // ranges] for i in range(1, ranges)}) if grams else []


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), characters: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (start, end), kept (the other bytes).

    Removed is every byte of a document's UTF-8 text that lies in a 50-byte
    string which also starts in a document of smaller id; strings are judged on
    the input. A null or empty text has no bytes. Rows that share an id don't
    count as smaller than each other; a null id is larger than all (ids are cast
    to long, of which the largest stands for a null one). ``carry``
    names columns that go along; others are not read. With ``characters``, a
    character stays unless all its bytes go, so ``kept`` is UTF-8. The result is computed when read, from tables in the
    shared folder that go at the session's end.
    """
    ship(suffix_runs.__name__)
    spark = docs.sparkSession
    held = {f"_carry{i}": F.col(c) for i, c in enumerate(carry)}
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)).alias("id"), text_of(text_col).alias("text"), *[c.alias(n) for n, c in held.items()])
    n_docs, n_bytes = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    chunks = max(1, math.ceil(n_bytes / CHUNK_BYTES))
    buckets = max(1, math.ceil(chunks / CHUNKS_PER_BUCKET))
    ranges = max(buckets, min(chunks, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    dealt = rows.select(_chunk_of(chunks).alias("chunk"), "id", "text", *held)
    table = _bucketed(dealt, "chunk", buckets)

    texts = table.select("chunk", "id", "text")
    announced = texts.groupBy("chunk").applyInArrow(suffix_runs.announcer(ranges), "bucket long, chunk long, hashes binary, counts binary")
    shared, shared_path = staged(announced.groupBy("bucket").applyInArrow(suffix_runs.matcher(HOT_ANCHORS), "chunk long, hashes binary, hot binary"), "shared")
    runs, _ = staged(texts.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(
        suffix_runs.sorter(_splitters(rows, n_docs, ranges), ranges), suffix_runs.RUN_FIELDS), "runs")
    answers = runs.where("kind = 0").select("bucket", "chunk", "a", "b", "c", "d").groupBy("bucket").applyInArrow(
        suffix_runs.merger, "chunk long, a binary, c binary, d binary")
    windows = runs.where("kind = 2").select("bucket", "chunk", "a", "b").groupBy("bucket").applyInArrow(
        suffix_runs.window_matcher, "chunk long, a binary, c binary, d binary")
    answers, _ = staged(answers.withColumn("kind", F.lit(0)).union(windows.withColumn("kind", F.lit(2))), "answers")
    discard(spark, shared_path)
    told = runs.where("kind IN (1, 3)").select("chunk", "kind", "a", "b", "c", "d").union(
        answers.select("chunk", "kind", "a", F.lit(None).cast("binary").alias("b"), "c", "d"))
    fields = ["id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary",
              *[f"{n} {table.schema[n].dataType.simpleString()}" for n in held]]
    out = table.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(suffix_runs.remover(characters), ", ".join(fields))
    return out.select(F.when(F.col("id") != _LAST_ID, F.col("id")).alias("doc_id"), "n_bytes", "n_removed", "spans", "kept",
                      *[F.col(n).alias(c) for n, c in zip(held, carry)])


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The documents, all columns, with the text that is left and its length."""
    rest = tuple(c for c in docs.columns if c not in (text_col, chars_col))
    out = remove_repeats(docs, id_col, text_col, carry=rest, characters=True)
    text = F.col("kept").cast("string")
    own = {text_col: text, chars_col: F.length(text).cast("long")}
    # by position: the operator's own columns, doc_id to kept, come before the carried ones
    renamed = out.toDF("_id", "_bytes", "_removed", "_spans", "kept", *[f"_{i}" for i in range(len(rest))])
    return renamed.select(*[(own[c] if c in own else F.col(f"_{rest.index(c)}")).alias(c) for c in docs.columns])
