"""Pretokenize (X6): JSONL split -> window-cropped, masked token rows -> Parquet.

One narrow stage per split (scan -> encode -> window -> mask -> emit), written
as plain part files. Input order is kept without a shuffle: every row carries
the input file and split it came from, and rows of one split stay in order, so
the next step's ordinals follow the input (``operators.ordinal``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmill.config import WINDOW_MAX_LENGTH
from chatmill.operators.encode import Tokenizer, filter_nonempty, tokenize_and_mask
from chatmill.operators.ordinal import FROM_BLOCK, FROM_FILE, positions_of, source_columns, write_run_index
from chatmill.sources import sinks
from chatmill.sources.files import try_scan, scan_jsonl


def pretokenize_frame(records: DataFrame, tok: Tokenizer = Tokenizer(),
                      max_length: int = WINDOW_MAX_LENGTH) -> DataFrame:
    """Window path over positioned JSONL rows; keeps the positions."""
    return filter_nonempty(tokenize_and_mask(records, tok, max_length, keep=positions_of(records)))


def pretokenize_split(spark: SparkSession, split: str, in_path: str, out_dir: str, tok: Tokenizer = Tokenizer(),
                      max_length: int = WINDOW_MAX_LENGTH, overwrite: bool = True) -> str | None:
    """One split; a missing input is skipped (returns None)."""
    out = f"{out_dir.rstrip('/')}/{split}_tokenized"
    sinks.refuse_existing(spark, [out], overwrite)
    src = try_scan(scan_jsonl, spark, in_path)
    if src is None:
        print(f"skipping {split}: no file at {in_path}")
        return None
    rows = source_columns(pretokenize_frame(src, tok, max_length)).withColumn("n_ids", F.size("input_ids"))
    sinks.write_tokenized(rows, out, sinks.save_mode(overwrite), extra=(FROM_FILE, FROM_BLOCK, "n_ids"))
    write_run_index(spark, out)
    return out


def pretokenize(spark: SparkSession, train_file: str, val_file: str, out_dir: str, tok: Tokenizer = Tokenizer(),
                max_length: int = WINDOW_MAX_LENGTH, overwrite: bool = True) -> dict:
    sinks.refuse_existing(spark, [f"{out_dir.rstrip('/')}/{s}_tokenized" for s in ("train", "val")], overwrite)
    return {s: pretokenize_split(spark, s, f, out_dir, tok, max_length, overwrite)
            for s, f in (("train", train_file), ("val", val_file))}
