"""Ids of tokens: few digits of the hash where they suffice, and the same ids."""

from pyspark.sql import functions as F

from chatmill.functions import tokens as TK

TEXTS = ["a superuser, 1<final2</final> <|im_end|>x", "\x01us\x01er é\u000b.", "", None, "<<|im_start|>assistantuser] -^ \\"]


def test_ids_of_any_number_of_buckets(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    for buckets in (1, 2, 1000, 1 << 17, 1 << 28, 1 << 29, 10**6 + 3):
        got = [r[0] for r in df.select(TK.text_to_ids("t", buckets=buckets)).collect()]
        assert got == [TK.py_encode(t, buckets=buckets) for t in TEXTS], buckets


def test_other_specials(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS + ["a]b^c-d\\e", "]]^^"]], "t string")
    for specials in (["]", "^b", "-", "\\"], ["user", "use", "user"], ["é", "<f"]):
        got = [r[0] for r in df.select(TK.text_to_ids("t", specials)).collect()]
        assert got == [TK.py_encode(t or "", specials) for t in TEXTS + ["a]b^c-d\\e", "]]^^"]], specials


def test_the_hash_is_read_as_far_as_it_counts(spark):
    df = spark.createDataFrame([("a",)], "t string").select(TK.hashed_id("t"))
    assert "substring(md5(cast(t" in (plan := df._jdf.queryExecution().optimizedPlan().toString()) and "11, 5)" in plan
