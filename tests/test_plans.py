"""Plan shape: what each operator should (not) put in the physical plan."""

from pyspark.sql import functions as F

from chatmill.operators.encode import Tokenizer, tokenize_and_mask, window_and_mask
from chatmill.operators.split import label_split, seeded_shuffle
from chatmill.plans.prepare import build_records
from chatmill.sources import tables

from conftest import SF_SMALL


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_marker_search_evaluated_once(spark):
    df = spark.createDataFrame([([1, 0, 7, 3] * 10,)], "input_ids array<int>")
    p = plan(window_and_mask(df, [0, 7], 16, 2))
    assert p.count("arrays_zip(") == 1
    assert "Generate" in p


def test_no_python_in_token_path(spark):
    recs = build_records(spark, SF_SMALL)
    p = plan(tokenize_and_mask(recs, Tokenizer(), 256))
    assert "EvalPython" not in p and "PythonUDF" not in p


def test_split_labeling_is_narrow(spark):
    df = seeded_shuffle(spark.range(100).select(F.col("id").cast("string").alias("rec_key")))
    p = plan(label_split(df, (1 << 40, "50")))
    assert "Exchange" not in p


def test_cap_pushdown_and_pruning(spark):
    from chatmill.operators.ordinal import SRC_BLOCK, SRC_FILE, scan_with_position
    from chatmill.sources.tables import table_path
    p = plan(tables.user_turns(spark, SF_SMALL, 10))
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,user)]" in p
    assert "Exchange" not in p                                # the cap is a condition on file and row index
    # the counting pass reads one data column
    stats = scan_with_position(spark, table_path(SF_SMALL, "conversations")).where("role = 'user'") \
        .groupBy(SRC_FILE, SRC_BLOCK).count()
    assert "ReadSchema: struct<role:string>" in plan(stats)


def test_fused_sources_scan_documents_once(spark):
    p = plan(build_records(spark, SF_SMALL), "simple")
    assert p.count("documents.parquet") == 1
    assert p.count("pages.parquet") == 1
