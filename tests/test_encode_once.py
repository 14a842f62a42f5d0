"""Several needles, or several lengths, encode a text once."""

from pyspark.sql import functions as F

from chatmill.operators import encode as E

TOK = E.Tokenizer()


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _records(spark):
    rows = [("a", f"say {'x y ' * i}<|im_start|>assistant", "b . " * (3 * i)) for i in range(12)] + [("b", "no marker", None), ("b", None, "")]
    return spark.createDataFrame(rows, "source string, instruction string, output string")


def test_tally_of_several_needles(spark):
    needles = {"marker": TOK.marker_ids, "stop": TOK.encode_py("."), "none": []}
    ids = E.text_ids(_records(spark), TOK, keep=["source"])
    got = E.marker_tally(ids, needles, by=["source"])
    assert _plan(got).count("regexp_extract_all") == 1
    want = [(name, *r) for name, needle in needles.items() for r in E.marker_tally(ids, needle, by=["source"]).select("source", "n_markers", "n_rows").collect()]
    assert sorted(map(tuple, got.select("needle", "source", "n_markers", "n_rows").collect())) == sorted(want)


def test_rows_of_several_lengths(spark):
    recs = _records(spark).withColumn("k", F.monotonically_increasing_id())
    got = E.encode_raw(recs, TOK, (10, 20, 40), keep=["k"])
    assert _plan(got).count("regexp_extract_all") == 1
    want = [(r.k, n, *r[1:]) for n in (10, 20, 40) for r in E.encode_raw(recs, TOK, n, keep=["k"]).collect()]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) < 42
