"""A conversation holding a third of all user turns is salted, not pulled into one task."""

from pyspark.sql import functions as F

from chatmill.plans.prepare import build_records
from chatmill.session import scratch_path
from chatmill.sources import tables

from conftest import SF_ORACLE


def _skewed_tables(spark):
    """conversations with a third of its rows moved into conversation 0 (turns
    renumbered so (conv_id, turn) stays unique); documents and pages as given."""
    out = scratch_path(spark, "skew")
    conv = spark.read.parquet(f"{SF_ORACLE}/conversations.parquet")
    hot = F.pmod(F.col("conv_id"), F.lit(3)) == 0
    moved = conv.select(
        F.when(hot, F.lit(0)).otherwise(F.col("conv_id")).cast("long").alias("conv_id"),
        F.when(hot, F.col("conv_id") * 1000 + F.col("turn")).otherwise(F.col("turn")).cast("long").alias("turn"),
        "role", "text")
    moved.write.parquet(f"{out}/conversations.parquet")
    for t in ("documents", "pages"):
        spark.read.parquet(f"{SF_ORACLE}/{t}.parquet").write.parquet(f"{out}/{t}.parquet")
    return out


def test_hot_conversation_is_salted(spark):
    d = _skewed_tables(spark)
    n_hot = spark.read.parquet(f"{d}/conversations.parquet").where("conv_id = 0 and role = 'user'").count()
    assert n_hot > 50
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",                 # force shuffle joins
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}     # keep tiny partitions apart
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        pairs = tables.qa_pairs(spark, d, pages=True, hot_rows=10)
        spread = (pairs.where("conv_id = 0").select(F.spark_partition_id().alias("p"))
                  .distinct().count())
        assert spread > 1                       # the hot conversation is split across tasks
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "_salt" in plan and "SortMergeJoin" in plan
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    # salting changes tasks, not results
    salted = build_records(spark, d, train_size=None, hot_rows=10).collect()
    plain = build_records(spark, d, train_size=None, hot_rows=10 ** 9).collect()
    assert sorted(map(tuple, salted)) == sorted(map(tuple, plain)) and len(salted) > n_hot
