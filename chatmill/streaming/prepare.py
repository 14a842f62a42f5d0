"""The prepare step on file streams: source rows -> records -> JSONL, once each.

Filters, context, templates and the record projection are per-row, so they run
unchanged on ``readStream``. The sink writes every micro-batch into a folder of
its own number (``foreachBatch``): a batch that is run again after a failure
replaces its folder, so no row is written twice, and the checkpoint makes sure
that none is left out. A folder counts once it is complete; ``read_records``
reads those only. Ordinals, caps, the shuffle and the split need the whole
input and stay batch-only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmill.config import NO_CONTEXT_PLACEHOLDER
from chatmill.operators import records as R
from chatmill.session import scratch_path
from chatmill.sources import sinks
from chatmill.sources.schemas import EVIDENCE_QA, RECORD, SPAN_QA, SPAN_QA_V2

#: source -> (its schema, source rows -> records)
SOURCES = {"squad": (SPAN_QA, R.span_qa_records), "squad_v2": (SPAN_QA_V2, R.span_qa_v2_records), "trivia_qa": (EVIDENCE_QA, R.evidence_qa_records)}
_BATCH = "batch="


def record_stream(spark: SparkSession, source: str, in_path: str, placeholder: str = NO_CONTEXT_PLACEHOLDER, files_per_batch: int | None = None, **tpl) -> DataFrame:
    """Records of the JSON-lines files of one source that land in ``in_path``."""
    schema, make = SOURCES[source]
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # a stream has no positions; the key is not written
    rows = reader.json(in_path).withColumns({"source": F.lit(source), "rec_key": F.lit(None).cast("string")})
    return make(rows, **(tpl | ({"placeholder": placeholder} if source == "trivia_qa" else {})))


def batch_path(out_path: str, batch_id: int) -> str:
    return f"{out_path.rstrip('/')}/{_BATCH}{batch_id:012d}"


def stream_prepare(spark: SparkSession, source: str, in_path: str, out_path: str, checkpoint: str | None = None,
                   files_per_batch: int | None = None, available_now: bool = True, write=sinks.write_jsonl, **tpl) -> str:
    """Write the records of a source's files as JSON lines below ``out_path``.

    With ``available_now`` the query drains what is there and stops; started
    again with the same ``checkpoint``, it goes on with new files only.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_path(out_path, batch_id), "overwrite")

    writer = record_stream(spark, source, in_path, files_per_batch=files_per_batch, **tpl).writeStream.foreachBatch(sink).option(
        "checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt"))
    query = (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()
    if available_now:
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    return out_path


def complete_batches(spark: SparkSession, out_path: str) -> list[str]:
    """The folders whose writer has ended, in order."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{out_path.rstrip('/')}/{_BATCH}*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(s.getPath().getParent()) for s in (found or []))


def read_records(spark: SparkSession, out_path: str) -> DataFrame:
    """The records (D5) of all complete batches."""
    paths = complete_batches(spark, out_path)
    return spark.read.schema(RECORD).json(paths) if paths else spark.createDataFrame([], RECORD)
