import os
import shutil

import pytest
from pyspark.sql import functions as F

from chatmill.operators import ordinal as O
from chatmill.operators.split import exact_split
from chatmill.plans import prepare as P
from chatmill.plans import train_data as TD
from chatmill.session import scratch_path, shared_dir
from chatmill.sources import qa_files
from chatmill.sources.files import scan_jsonl

from conftest import SF_ORACLE, SF_SMALL


def _jsonl(spark, rows, parts):
    path = scratch_path(spark, "test-jsonl")
    spark.createDataFrame(rows, "instruction string, output string").coalesce(parts).write.json(path)
    return path


def test_no_query_caps_rows_past_the_old_default(spark, tmp_path):
    from oracle_check import TABLES, compare, duck
    d = str(tmp_path)
    for t in TABLES:
        if t != "conversations" and os.path.exists(f"{SF_ORACLE}/{t}.parquet"):
            os.symlink(f"{SF_ORACLE}/{t}.parquet", f"{d}/{t}.parquet")
    conv = spark.read.parquet(f"{SF_ORACLE}/conversations.parquet")
    users = conv.where("role = 'user'").count()
    times = 20_000 // users + 2
    (conv.crossJoin(spark.range(times)).withColumn("conv_id", F.col("conv_id") + F.col("id") * 1_000_000).drop("id")
     .repartitionByRange(1, "conv_id", "turn").sortWithinPartitions("conv_id", "turn").write.parquet(f"{d}/many"))
    part = next(f for f in os.listdir(f"{d}/many") if f.endswith(".parquet"))
    shutil.move(f"{d}/many/{part}", f"{d}/conversations.parquet")
    got = compare(spark, d, ["union_sources", "include_sources", "split_counts", "scan_span_qa", "prefix_cap"], duck(d))
    assert all(r["match"] for r in got.values()), got
    assert got["scan_span_qa"]["rows"] > 20_000


def test_ordinals_survive_a_changed_split_plan(spark):
    n = 20_000
    path = _jsonl(spark, [(str(i), "x" * 40) for i in range(n)], 3)
    df = O.with_ordinal(scan_jsonl(spark, path))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
        again = O.with_ordinal(scan_jsonl(spark, path))
        many = again.select("ordinal", "instruction").collect()
        few = df.select("ordinal", "instruction").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(r.ordinal for r in few) == sorted(r.ordinal for r in many) == list(range(n))
    assert {r.ordinal: r.instruction for r in few} == {r.ordinal: r.instruction for r in many}


def test_part_numbers_past_99999_follow(spark):
    src = _jsonl(spark, [("one", "")], 1)
    path = scratch_path(spark, "test-parts")
    os.makedirs(path)
    part = next(f"{src}/{f}" for f in os.listdir(src) if f.startswith("part-"))
    names = ["part-99999-a.json", "part-100000-a.json", "part-10001-a.json", "part-00002-a.json"]
    for i, n in enumerate(names):
        with open(part) as f, open(f"{path}/{n}", "w") as g:
            g.write(f.read().replace("one", n))
    got = [r.instruction for r in O.with_ordinal(scan_jsonl(spark, path)).orderBy("ordinal").collect()]
    assert got == ["part-00002-a.json", "part-10001-a.json", "part-99999-a.json", "part-100000-a.json"]


def test_a_filtered_scan_is_refused_and_a_cap_skips_files(spark):
    path = scratch_path(spark, "test-cap")
    spark.range(0, 4_000, 1, 8).withColumn("v", F.col("id") % 3).write.parquet(path)
    with pytest.raises(Exception, match="rows are missing"):
        O.with_ordinal(O.scan_with_position(spark, path).where("id <> 5")).count()
    capped = O.prefix_cap(O.scan_with_position(spark, path).where("v = 0"), 200)
    assert [r.id for r in capped.orderBy("id").collect()] == [3 * i for i in range(200)]
    assert capped.select(F.input_file_name().alias("f")).distinct().count() == 2
    plan = capped._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    assert plan.collectLeaves().apply(0).metrics().apply("numFiles").value() == 2


@pytest.mark.parametrize("fraction", [0.13, 0.5, 0.02])
def test_exact_split_with_repeated_keys(spark, fraction):
    rows = [(f"k{i % 7}", f"t{i % 3}") for i in range(1_000)]
    got = exact_split(spark.createDataFrame(rows, "rec_key string, text string"), fraction).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"val": int(1_000 * fraction), "train": 1_000 - int(1_000 * fraction)}


def test_stream_timeout_raises(spark):
    from chatmill.streaming.rowwise import stream_pretokenize
    path = _jsonl(spark, [("q " * 50, "a " * 50)] * 200, 4)
    with pytest.raises(TimeoutError):
        stream_pretokenize(spark, path, scratch_path(spark, "test-stream"), timeout_s=0.01)


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="checkpoint"):
        shared_dir(Session())


def test_existing_outputs_are_refused_before_any_work(spark):
    out = scratch_path(spark, "test-guard")
    spark.range(1).write.json(f"{out}/val.jsonl")
    with pytest.raises(FileExistsError):
        P.prepare(spark, "/nowhere", out, overwrite=False)
    assert os.listdir(out) == ["val.jsonl"]


def test_an_empty_train_set_is_refused(spark):
    path = _jsonl(spark, [], 1)
    with pytest.raises(ValueError, match="No training"):
        TD.load_datasets(spark, train_file=path)


def test_prepare_over_three_files(spark):
    base, out = scratch_path(spark, "test-qa"), scratch_path(spark, "test-prepared")
    rows = {"squad": ['{"question":"q%d","context":"c","answers":{"text":["a","b"]}}' % i for i in range(30)],
            "squad_v2": ['{"question":"q%d","context":"c","answers":{"text":["a"]},"is_impossible":%s}' % (i, "true" if i % 2 else "false") for i in range(20)],
            "trivia_qa": ['{"question":"q","answer":{"value":"v"},"entity_pages":[{"wiki_context":"W"}],"evidence":null,"search_results":{}}'] * 10}
    for s, lines in rows.items():
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(2).write.text(f"{base}/{s}")
    sources = {s: read(spark, f"{base}/{s}") for s, read in qa_files.READERS.items()}
    assert P.prepare_sources(spark, sources, out, val_fraction=0.1)["num_total"] == 30 + 10 + 10
    assert P.records_of(sources, train_size=10).groupBy("source").count().where("source = 'squad'").first()["count"] == 10
    assert "W" in P.records_of({"trivia_qa": sources["trivia_qa"]}).first()["instruction"]
    with pytest.raises(ValueError, match="unknown"):
        P.records_of({"web": sources["squad"]})


def test_smoke_tables_prepare(spark):
    assert P.build_records(spark, SF_SMALL).count() > 0
