"""F1-F3, J2, J6 on the literal edge rows of FIXTURES.md §3."""

import json

from pyspark.sql import functions as F

from chatmill.config import NO_CONTEXT_PLACEHOLDER
from chatmill.operators import records as R
from chatmill.operators.context import resolve_context
from chatmill.sources.schemas import EVIDENCE_QA, SPAN_QA_V2


def span_rows(spark, rows):
    return spark.createDataFrame(rows, SPAN_QA_V2).withColumn("source", F.lit("squad")) \
        .withColumn("rec_key", F.monotonically_increasing_id().cast("string"))


def test_filter_span_qa_edges(spark):
    rows = [
        ("q1", "ctx", {"text": ["A"]}, None),          # kept
        (None, "ctx", {"text": ["A"]}, None),          # null question
        ("q3", None, {"text": ["A"]}, None),           # null context
        ("q4", "ctx", None, None),                     # null struct
        ("q5", "ctx", {"text": None}, None),           # null list
        ("q6", "ctx", {"text": []}, None),             # empty list
        ("q7", "ctx", {"text": [""]}, None),           # blank answer: kept
        ("q8", "ctx", {"text": [None]}, None),         # null first answer: dropped (deviation)
        ("  ", "ctx", {"text": ["A"]}, None),          # blank question
    ]
    out = R.span_qa_records(span_rows(spark, rows)).collect()
    assert len(out) == 2
    finals = sorted(r.output.split("<final>")[1].split("</final>")[0] for r in out)
    assert finals == ["", "A"]


def test_filter_answerable(spark):
    rows = [("q", "c", {"text": ["A"]}, None), ("q", "c", {"text": ["A"]}, True), ("q", "c", {"text": ["A"]}, False)]
    assert R.filter_answerable(span_rows(spark, rows)).count() == 2


def evidence(spark, rows):
    data = [("q", {"value": "A"}, *[None if v is None else json.dumps(v) for v in r]) for r in rows]
    return spark.createDataFrame(data, EVIDENCE_QA).withColumn("source", F.lit("trivia_qa")) \
        .withColumn("rec_key", F.monotonically_increasing_id().cast("string"))


CASES = [
    # (entity_pages, evidence, search_results) -> expected context
    (([{"wiki_context": "", "text": "T"}], None, None), "T"),
    (([{"wiki_context": "  ", "text": "T"}], ["E"], None), "E"),          # blank wins, then tier fails
    (([{}, {"text": "T"}], None, None), NO_CONTEXT_PLACEHOLDER),          # only element 0 counts
    ((None, ["E"], None), "E"),
    ((None, [{"value": "V"}], None), "V"),
    ((None, None, [{"snippet": "S", "title": "T"}]), "S"),
    ((None, None, {"zz": [{"snippet": "S"}], "aa": {"title": "T"}}), "S"),   # insertion order
    ((None, None, {"zz": {"title": "  "}, "aa": {"title": "T"}}), "T"),    # blank value -> next value
    ((None, None, {"d": ["x"]}), NO_CONTEXT_PLACEHOLDER),                   # list of strings
    (({"wiki_context": ["w"]}, None, None), NO_CONTEXT_PLACEHOLDER),        # struct of lists
    (([{"text": 5}], None, None), NO_CONTEXT_PLACEHOLDER),                  # non-string pick is missing
    (([], [], []), NO_CONTEXT_PLACEHOLDER),
    ((None, [" E \t"], None), "E"),
]


def test_context_tiers(spark):
    df = evidence(spark, [c for c, _ in CASES])
    got = [r.context for r in resolve_context(df).orderBy(F.col("rec_key").cast("long")).collect()]
    assert got == [e for _, e in CASES]


def test_filter_evidence_qa(spark):
    data = [("q", {"value": "A"}, None, None, None), ("q", {"value": "  "}, None, None, None),
            ("q", None, None, None, None), (" ", {"value": "A"}, None, None, None)]
    df = spark.createDataFrame(data, EVIDENCE_QA)
    assert R.filter_evidence_qa(df).count() == 1


def test_struct_of_arrays_opt_in(spark):
    rows = [({"wiki_context": ["W"], "title": ["t"]}, None, None),
            (None, None, {"description": [" D "], "rank": [1]}),
            ([{"text": "T"}], None, None)]
    df = evidence(spark, rows)
    as_written = [r.context for r in resolve_context(df).orderBy(F.col("rec_key").cast("long")).collect()]
    opted = [r.context for r in resolve_context(df, struct_of_arrays=True).orderBy(F.col("rec_key").cast("long")).collect()]
    assert as_written == [NO_CONTEXT_PLACEHOLDER, NO_CONTEXT_PLACEHOLDER, "T"]
    assert opted == ["W", "D", "T"]
