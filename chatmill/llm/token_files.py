"""Token-id files: ids in blocks of canonical length-limited Huffman codes.

A file set is a folder with ``blocks`` (Parquet; a row is a block that can be
decoded alone, see ``huffman``; part files and rows ascend by doc_id) and
``code`` (the length of each id's code, from the counts over all documents).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe_model, huffman
from .bpe import vocabulary_file
from .common import NULL_ID, bucket_of, discard, per_process, range_bounds, ship, staged

DOCS_PER_RANGE = 1_024
#: Ids above this have no code: the code table is one byte an id on the driver.
MAX_ID = 1 << 24


def write_tokens(docs: DataFrame, vocabulary: str, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text with the tokenizers library, append ``end_id``,
    and write the file set in ascending doc_id order.

    A null or empty text is the end id alone. Ids are cast to long, of which the
    least stands for a null one, which so comes first. Rows that
    share an id are written in an undefined order. Other columns are not read.
    Texts are encoded once and are not shuffled; their ids are staged with the
    counts of each batch, coded, and dealt by ranges of doc_id that one part file holds in order.
    """
    ship(bpe_model.__name__, huffman.__name__)
    spark = docs.sparkSession
    content = vocabulary_file(spark, vocabulary)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), F.col(text_col).alias("text"))
    ids, staged_path = staged(rows.mapInArrow(bpe_model.library_encoder(content, end_id, per_process, huffman.packed_counts), "id long, ids binary, counts binary"), "ids")
    # at most one row an id of the vocabulary
    counts = ids.select("counts").where(F.col("counts").isNotNull()).mapInArrow(huffman.counter, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    if any(r["token"] > MAX_ID for r in counts):
        raise ValueError(f"ids above {MAX_ID}")
    table = np.zeros(max((r["token"] for r in counts), default=0) + 1, np.int64)
    for r in counts:
        table[r["token"]] = r["n"]
    lengths = huffman.code_lengths(table)
    spark.createDataFrame([(lengths.tobytes(),)], "lengths binary").coalesce(1).write.parquet(f"{path}/code")
    bounds = range_bounds(ids.select("id"), F.col("id"), DOCS_PER_RANGE)
    parts = max(1, min(len(bounds), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    part = F.floor(F.col("range") * parts / max(1, len(bounds))).cast("int")
    coded = ids.select(bucket_of(F.col("id"), bounds).cast("long").alias("range"), "id", "ids").mapInArrow(
        huffman.coder(spark.sparkContext.broadcast(lengths.tobytes())), "range long, id long, n_ids long, checkpoints binary, payload binary")
    (coded.repartitionById(parts, part).sortWithinPartitions("range", "id").mapInArrow(huffman.block_writer, huffman.BLOCK_FIELDS)
     .write.option("compression", "uncompressed").parquet(f"{path}/blocks"))
    discard(spark, staged_path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids before it), n_tokens, ids (little-endian 32-bit) of
    every document of a file set. Starts come from the blocks' lengths alone:
    of the ranges (at most 10,000 rows), then within each range."""
    ship(huffman.__name__)
    blocks = spark.read.parquet(f"{path}/blocks")
    code = spark.sparkContext.broadcast(bytes(spark.read.parquet(f"{path}/code").first()["lengths"]))
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = blocks.select("range", "n_ids").groupBy("range").agg(F.sum("n_ids").alias("n_ids"))
    ranges = ranges.select("range", before(Window.orderBy("range")).alias("_range_start"))
    starts = blocks.select("range", "seq", "n_ids").withColumn("_start", before(Window.partitionBy("range").orderBy("seq")))
    starts = starts.join(F.broadcast(ranges), "range").select("range", "seq", (F.col("_start") + F.col("_range_start")).alias("first"))
    placed = blocks.join(starts, ["range", "seq"]).select("first", "doc_ids", "lengths", "checkpoints", "payload")
    out = placed.mapInArrow(huffman.block_reader(code), "id long, start long, n_tokens long, ids binary")
    return out.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"), "start", "n_tokens", "ids")
