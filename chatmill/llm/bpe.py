"""BPE encoding and decoding of whole documents; the method is in ``bpe_model``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_model
from .common import per_process, ship

#: The largest vocabulary file that is broadcast; a larger one raises an error.
MAX_FILE_BYTES = 64 << 20


def vocabulary_file(spark: SparkSession, path: str):
    """A vocabulary file, read on the driver and broadcast."""
    with open(path, encoding="utf-8") as f:
        content = f.read(MAX_FILE_BYTES + 1)
    if len(content) > MAX_FILE_BYTES:
        raise ValueError(f"{path} is larger than {MAX_FILE_BYTES} bytes")
    return spark.sparkContext.broadcast(content)


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, decoded: the ids of every whole text, and the text that the
    ids stand for.

    A null or empty text has no ids and decodes to the empty text. Strings of
    added tokens become their ids. Rows stay as they are, repeated or not, with
    a null id too; other columns are not read. One narrow pass, no shuffle.
    """
    ship(bpe_model.__name__)
    content = vocabulary_file(docs.sparkSession, vocabulary)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(bpe_model.codec(content, per_process), f"id {id_type}, ids array<int>, decoded string").withColumnRenamed("id", "doc_id")
