"""The prepare step on streams: equal to batch, and once each over restarts."""

import os

import pytest

from chatmill.operators import records as R
from chatmill.session import scratch_path
from chatmill.sources import qa_files as QF
from chatmill.sources import sinks, tables
from chatmill.streaming.prepare import batch_path, complete_batches, read_records, stream_prepare

from conftest import SF_SMALL


def _pairs(df):
    return sorted((r.instruction, r.output) for r in df.collect())


def _source(spark):
    path = scratch_path(spark, "stream-in")
    tables.span_qa(spark, SF_SMALL).select("question", "context", "answers").repartition(6).write.json(path)
    return path


def test_equal_to_batch(spark):
    path = _source(spark)
    out = stream_prepare(spark, "squad", path, scratch_path(spark, "stream-out"), files_per_batch=2)
    assert len(complete_batches(spark, out)) == 3
    assert _pairs(read_records(spark, out)) == _pairs(R.span_qa_records(QF.read_span_qa(spark, path)))


def test_evidence_source(spark):
    path = scratch_path(spark, "stream-ev")
    QF.write_evidence_qa(tables.evidence_qa(spark, SF_SMALL), path)
    out = stream_prepare(spark, "trivia_qa", path, scratch_path(spark, "stream-ev-out"), placeholder="none given")
    assert _pairs(read_records(spark, out)) == _pairs(R.evidence_qa_records(QF.read_evidence_qa(spark, path), placeholder="none given"))


def test_restart_after_a_failure_writes_no_row_twice(spark):
    path, out, checkpoint = _source(spark), scratch_path(spark, "stream-fail"), scratch_path(spark, "ckpt")

    def fails_after_writing(batch, to, mode):
        sinks.write_jsonl(batch, to, mode)
        if to == batch_path(out, 1):
            raise OSError("the driver is lost before the batch is committed")

    with pytest.raises(Exception):
        stream_prepare(spark, "squad", path, out, checkpoint, files_per_batch=2, write=fails_after_writing)
    assert len(complete_batches(spark, out)) == 2
    stream_prepare(spark, "squad", path, out, checkpoint, files_per_batch=2)
    want = _pairs(R.span_qa_records(QF.read_span_qa(spark, path)))
    assert _pairs(read_records(spark, out)) == want
    stream_prepare(spark, "squad", path, out, checkpoint, files_per_batch=2)            # nothing is new
    assert _pairs(read_records(spark, out)) == want
    tables.span_qa(spark, SF_SMALL).select("question", "context", "answers").coalesce(1).write.mode("append").json(path)
    stream_prepare(spark, "squad", path, out, checkpoint)
    assert _pairs(read_records(spark, out)) == sorted(want * 2)


def test_a_folder_that_is_not_complete_does_not_count(spark):
    out = scratch_path(spark, "stream-part")
    folder = batch_path(out, 0).removeprefix("file:")
    os.makedirs(folder)
    with open(f"{folder}/part-0.json", "w") as f:
        f.write('{"instruction":"i","output":"o"}\n')
    assert read_records(spark, out).count() == 0
    open(f"{folder}/_SUCCESS", "w").close()
    assert read_records(spark, out).count() == 1
