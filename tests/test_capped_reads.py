"""L1, L3: capped reads open no more files than they need."""

import os

from pyspark.sql import functions as F

from chatmill.operators.ordinal import prefix_cap, read_run_index, scan_head, scan_prefix, scan_with_position, with_ordinal, write_run_index
from chatmill.plans import train_data as TD
from chatmill.plans.pretokenize import pretokenize_split
from chatmill.session import scratch_path
from chatmill.sources.qa_files import read_span_qa

from test_plans import plan


def _json_files(spark, sizes, broken_from=None):
    """JSON files with rising ids; files from ``broken_from`` on cannot be read."""
    folder = scratch_path(spark, "json").removeprefix("file:")
    os.makedirs(folder)
    at = 0
    for i, n in enumerate(sizes):
        with open(f"{folder}/part-{i:05d}-x y.json" + (".gz" if broken_from is not None and i >= broken_from else ""), "w") as f:
            f.write("not gzip" if broken_from is not None and i >= broken_from else "".join(f'{{"id":{at + j}}}\n' for j in range(n)))
        at += n
    return folder


def test_json_cap_opens_the_first_files_only(spark):
    folder = _json_files(spark, [60] * 10, broken_from=2)
    got = [(r.ordinal, r.id) for r in scan_prefix(spark, folder, 100, "json", "id long").orderBy("ordinal").collect()]
    assert got == [(i, i) for i in range(100)]
    one = _json_files(spark, [150] + [10] * 9, broken_from=1)
    assert scan_prefix(spark, one, 100, "json", "id long").count() == 100


def test_json_cap_equals_the_whole_read(spark):
    folder = _json_files(spark, [3, 0, 7, 1, 1, 12])
    whole = with_ordinal(scan_with_position(spark, folder, "json", "id long"))
    for cap in (1, 3, 4, 11, 24, 99):
        want = sorted((r.ordinal, r.id) for r in prefix_cap(whole, cap).collect())
        assert sorted((r.ordinal, r.id) for r in scan_prefix(spark, folder, cap, "json", "id long").collect()) == want
    odd = scan_prefix(spark, folder, 5, "json", "id long", narrow=lambda d: d.where(F.col("id") % 2 == 1))
    assert sorted(r.id for r in odd.collect()) == [1, 3, 5, 7, 9]
    assert scan_prefix(spark, _json_files(spark, [0]), 5, "json", "id long").count() == 0


def test_capped_source(spark):
    folder = scratch_path(spark, "qa-cap").removeprefix("file:")
    os.makedirs(folder)
    for i in range(3):
        with open(f"{folder}/part-{i:05d}.json", "w") as f:
            f.write("".join(f'{{"question":"q{i}-{j}","context":"c","answers":{{"text":["a"]}}}}\n' for j in range(4)))
    rows = read_span_qa(spark, folder, cap=6).orderBy("ordinal").collect()
    assert [r.rec_key for r in rows] == [f"squad:{i}" for i in range(6)] and rows[5].question == "q1-1"


def _tokenized(spark, sizes):
    path, at = scratch_path(spark, "head"), 0
    for n in sizes:
        (spark.range(at, at + n).coalesce(1).select(F.array(F.col("id").cast("int")).alias("input_ids"), F.array(F.lit(1)).alias("attention_mask"),
                                                    F.array(F.lit(-100)).alias("labels")).write.mode("append").parquet(path))
        at += n
    write_run_index(spark, path)
    return path


def test_run_index_names_the_files(spark):
    path = _tokenized(spark, [5, 40, 17, 30])
    whole = with_ordinal(scan_with_position(spark, path)).select("ordinal", "input_ids").orderBy("ordinal").collect()
    assert [r.ordinal for r in whole] == list(range(92))                    # the index beside the files is no data
    for cap in (1, 5, 6, 50, 92, 1000):
        head = scan_head(spark, path, cap)
        assert sorted((r.ordinal, r.input_ids) for r in head.collect()) == [(r.ordinal, r.input_ids) for r in whole[:cap]]
    first = scan_head(spark, path, 1)
    assert len(first.inputFiles()) <= 2                                     # one of four, and the run table
    assert " paths)" not in plan(first) and "Exchange" not in plan(first).replace("BroadcastExchange", "")


def test_a_changed_folder_has_no_index(spark):
    path = _tokenized(spark, [5, 6])
    assert read_run_index(spark, path) is not None
    spark.read.parquet(path).limit(2).coalesce(1).write.mode("append").parquet(path)
    assert read_run_index(spark, path) is None and scan_head(spark, path, 3) is None
    other = scratch_path(spark, "bare")
    spark.range(3).write.parquet(other)
    assert read_run_index(spark, other) is None


def test_head_of_both_kinds_of_split(spark):
    base = scratch_path(spark, "split")
    recs = spark.range(60).repartition(4).select(F.concat(F.lit("<|im_start|>user\nq"), "id", F.lit("<|im_end|>\n<|im_start|>assistant")).alias("instruction"),
                                                 F.concat(F.lit("answer one two three four five six seven eight nine "), "id").alias("output"))
    recs.write.json(f"{base}/train.jsonl")
    pretokenize_split(spark, "train", f"{base}/train.jsonl", base)
    for tdir, raw in ((f"{base}/train_tokenized", None), (None, f"{base}/train.jsonl")):
        whole = TD.load_split(spark, tdir, raw)[1]
        head = TD.load_split(spark, tdir, raw, max_samples=20)[1]
        want = sorted((r.ordinal, r.input_ids) for r in whole.where("ordinal < 20").collect())
        assert sorted((r.ordinal, r.input_ids) for r in head.collect()) == want and len(want) == 20
