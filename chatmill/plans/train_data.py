"""Train-time data path: resolve each split, encode raw text if needed,
cap, and collate into padded batches (S6, S7, X2r, L3, X4, A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmill.config import EVAL_BATCH_SIZE, PAD_MULTIPLE, RAW_MAX_LENGTH, TRAIN_BATCH_SIZE
from chatmill.operators.batching import pad_batches
from chatmill.operators.encode import Tokenizer, encode_raw
from chatmill.operators.ordinal import head_cap, positions_of, scan_head, scan_prefix, stage_in_order, with_ordinal
from chatmill.sources.files import resolve_split, tokenized_schema
from chatmill.sources.schemas import RECORD


#: Batches of one folder of ``write_batches``.
BATCHES_PER_FOLDER = 8_192


def load_split(spark: SparkSession, tokenized_dir: str | None, raw_file: str | None, tok: Tokenizer = Tokenizer(),
               max_length: int = RAW_MAX_LENGTH, max_samples: int | None = None,
               bos_id: int | None = None) -> tuple[str, DataFrame] | None:
    """Rows (ordinal, input_ids, attention_mask, labels) of one split, or None."""
    def encoded(df):
        return encode_raw(df, tok, max_length, bos_id, keep=positions_of(df)).withColumn("n_ids", F.size("input_ids"))

    def raw(df):
        # tokenize once: the ordinal and batching passes read the staged columns they need
        return stage_in_order(encoded(df), "encoded")
    found = resolve_split(spark, tokenized_dir, raw_file, raw if not max_samples else None)
    if found is None:
        return None
    origin, df = found
    if not max_samples:
        return origin, with_ordinal(df)
    if origin == "tokenized":                       # the folder's run index, if it has one, names the files
        head = scan_head(spark, tokenized_dir, int(max_samples), tokenized_schema(spark, tokenized_dir))
        return origin, head if head is not None else head_cap(with_ordinal(df), max_samples)
    # the cap counts rows that are left after tokenizing: files are tokenized in order until it is reached
    return origin, scan_prefix(spark, raw_file, int(max_samples), "json", RECORD, encoded)


def load_datasets(spark: SparkSession, train_dir=None, train_file=None, eval_dir=None, eval_file=None,
                  tok: Tokenizer = Tokenizer(), max_length: int = RAW_MAX_LENGTH,
                  max_train_samples=None, max_eval_samples=None):
    """Both splits; training data is required, evaluation data optional."""
    train = load_split(spark, train_dir, train_file, tok, max_length, max_train_samples)
    if train is None or train[1].isEmpty():
        raise ValueError("No training dataset found. Provide a train file or a tokenized train directory.")
    evald = load_split(spark, eval_dir, eval_file, tok, max_length, max_eval_samples)
    return train, evald


def collate(df: DataFrame, tok: Tokenizer = Tokenizer(), batch_size: int = TRAIN_BATCH_SIZE,
            mixed_precision: bool = True) -> DataFrame:
    """Padded batches; multiple of 8 only under mixed precision."""
    return pad_batches(df, batch_size, tok.pad_token_id, PAD_MULTIPLE if mixed_precision else None)


def write_batches(batches: DataFrame, path: str, overwrite: bool = True, batches_per_folder: int = BATCHES_PER_FOLDER) -> None:
    """Padded batches (D9) as Parquet, without moving rows: folders
    ``chunk=0000000012`` ascend by ``batch_id``, and in each every file ascends
    by ``ordinal``. A batch that the edge of a scan's task cut lies in two files
    of one folder."""
    mode = "overwrite" if overwrite else "errorifexists"
    chunk = F.lpad(F.floor(F.col("batch_id") / F.lit(int(batches_per_folder))).cast("string"), 10, "0")
    (batches.select("ordinal", "batch_id", "width", "input_ids", "attention_mask", "labels", chunk.alias("chunk"))
     .sortWithinPartitions("chunk", "ordinal")
     .write.mode(mode).partitionBy("chunk").parquet(path))


__all__ = ["load_split", "load_datasets", "collate", "write_batches", "TRAIN_BATCH_SIZE", "EVAL_BATCH_SIZE"]
