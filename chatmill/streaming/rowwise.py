"""Row-wise steps on a file stream.

Text building, tokenizing, windowing and masking are per-row projections,
so the window path runs unchanged on ``readStream``. Ordinals, caps, the
split and batching need the whole input and stay batch-only.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from chatmill.config import WINDOW_MAX_LENGTH
from chatmill.operators.encode import Tokenizer, filter_nonempty, tokenize_and_mask
from chatmill.session import scratch_path
from chatmill.sources.schemas import RECORD


def stream_pretokenize(spark: SparkSession, in_path: str, out_path: str, tok: Tokenizer = Tokenizer(),
                       max_length: int = WINDOW_MAX_LENGTH, checkpoint: str | None = None,
                       available_now: bool = True, timeout_s: float | None = None) -> str:
    """Tokenize every JSONL record that lands in ``in_path`` into Parquet at
    ``out_path``. With ``available_now`` the query drains what is there and
    stops; the checkpoint in the shared folder makes it restartable. With a
    ``timeout_s``, a drain that takes longer is stopped and raises TimeoutError."""
    src = spark.readStream.schema(RECORD).json(in_path)
    rows = filter_nonempty(tokenize_and_mask(src, tok, max_length))
    writer = (rows.writeStream.format("parquet").option("path", out_path)
              .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    q = writer.start()
    if available_now:
        done = q.awaitTermination(timeout_s) if timeout_s is not None else (q.awaitTermination(), True)[1]
        if not done:
            q.stop()
            raise TimeoutError(f"the stream was not drained within {timeout_s} s; {out_path} is partial")
        if q.exception() is not None:
            raise q.exception()
    return out_path
