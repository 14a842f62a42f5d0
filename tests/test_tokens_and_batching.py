"""Tokenizer parity with the driver-side twin, vocab, padding."""

from pyspark.sql import functions as F

from chatmill.functions import tokens as TK
from chatmill.operators import vocab as V
from chatmill.operators.batching import pad_batches
from chatmill.operators.encode import Tokenizer, encode_raw
from chatmill.operators.ordinal import scan_with_position, with_ordinal
from chatmill.session import scratch_path

TEXTS = ["superuser said <|im_start|>assistant hi", "é 12ab, x\ty z <final>42</final>",
         "\x01<|im_end|>\x01", "", "userassistant<scratchpad>"]


def test_split_tokens_parity(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = [r[0] for r in df.select(TK.split_tokens("t")).collect()]
    assert got == [TK.py_split_tokens(t) for t in TEXTS]
    assert got[0][:3] == ["super", "user", "said"]


def test_ids_parity_and_specials(spark):
    tok = Tokenizer()
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = [r[0] for r in df.select(tok.ids("t")).collect()]
    assert got == [tok.encode_py(t) for t in TEXTS]
    assert tok.marker_ids == [0, 7]


def test_raw_path_keeps_unmasked_when_marker_missing(spark):
    tok = Tokenizer()
    rows = [("no marker here " * 3, "answer " * 10), ("x " * 50 + "<|im_start|>assistant", "a " * 20)]
    df = spark.createDataFrame(rows, "instruction string, output string")
    out = encode_raw(df, tok, max_length=30).collect()
    assert len(out) == 2
    assert all(-100 not in r.labels for r in out)   # second row: marker truncated away


def test_fit_vocab_bounded_and_ordered(spark):
    df = spark.createDataFrame([(["b", "a", "b", "user", "c", "c", "c"],)], "tokens array<string>")
    v = {r.token: (r.id, r["count"]) for r in V.fit_vocab(df, "tokens", 10).collect()}
    assert v["user"][0] == 6 and v["c"] == (8, 3) and v["b"] == (9, 2) and "a" not in v


def test_pad_batches_across_split_edges(spark):
    path = scratch_path(spark, "pad")
    lens = [3, 1, 5, 9, 2, 2, 7, 4, 1, 6, 3]
    rows = [([i] * n, [1] * n, [-100] + [i] * (n - 1)) for i, n in enumerate(lens)]
    schema = "input_ids array<int>, attention_mask array<int>, labels array<int>"
    for chunk in (rows[:3], rows[3:4], rows[4:9], rows[9:]):     # batches cut by file edges
        spark.createDataFrame(chunk, schema).coalesce(1).write.mode("append").parquet(path)
    out = pad_batches(scan_with_position(spark, path), 4, pad_id=99, pad_multiple=8).orderBy("ordinal").collect()
    assert [r.ordinal for r in out] == list(range(len(lens)))
    real = [sum(r.attention_mask) for r in out]          # unpadded length at each ordinal
    assert sorted(real) == sorted(lens)
    for r in out:
        b = r.ordinal // 4
        w = max(real[b * 4:(b + 1) * 4])
        w = -(-w // 8) * 8
        n = real[r.ordinal]
        assert r.width == w == len(r.input_ids) == len(r.labels) == len(r.attention_mask)
        assert r.input_ids[n:] == [99] * (w - n) and r.attention_mask[n:] == [0] * (w - n)
        assert r.labels[n:] == [-100] * (w - n)


def _token_files(spark, sizes, seed=3):
    import random
    rnd = random.Random(seed)
    path = scratch_path(spark, "pads")
    for n in sizes:
        rows = [([rnd.randrange(9)] * k, [1] * k, [-100] + [5] * (k - 1)) for k in (rnd.randrange(1, 30) for _ in range(n))]
        spark.createDataFrame(rows, "input_ids array<int>, attention_mask array<int>, labels array<int>").coalesce(1).write.mode("append").parquet(path)
    return with_ordinal(scan_with_position(spark, path))


def test_interior_rows_pass_no_exchange(spark):
    df = _token_files(spark, [50, 3, 47, 20])
    out = pad_batches(df, 4, 99, 8)
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in p.replace("BroadcastExchange", "") and "SortMergeJoin" not in p and "Sort " not in p
    from chatmill.operators import batching as B
    cut = {r.batch_id for r in B.cut_batches(df, 4).collect()}
    assert len(cut) <= 4                                 # at most one at the end of each file


def test_in_place_equals_join(spark, monkeypatch):
    from chatmill.operators import batching as B
    for sizes, size in (([50, 3, 47, 20], 4), ([1, 1, 1, 1, 1], 2), ([9], 100), ([33], 1), ([13, 12], 5)):
        df = _token_files(spark, sizes)
        want = sorted(map(tuple, B._pad_by_join(df, size, 99, 8, "ordinal", ()).collect()))
        assert sorted(map(tuple, pad_batches(df, size, 99, 8).collect())) == want
    shuffled = df.repartition(7)                          # rows that do not lie together
    assert sorted(map(tuple, pad_batches(shuffled, 5, 99, 8).collect())) == want
    monkeypatch.setattr(B, "MAX_BROADCAST_EDGES", 0)
    assert sorted(map(tuple, pad_batches(df, 5, 99, 8).collect())) == want


def test_long_task_in_several_record_batches(spark):
    from chatmill.operators import batching as B
    df = _token_files(spark, [101])
    want = sorted(map(tuple, B._pad_by_join(df, 4, 0, None, "ordinal", ()).collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert sorted(map(tuple, pad_batches(df, 4, 0).collect())) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_batch_files_are_in_order(spark):
    from chatmill.plans.train_data import write_batches
    path = scratch_path(spark, "batches")
    write_batches(pad_batches(_token_files(spark, [30, 41, 29]), 4, 0, 8), path, batches_per_folder=5)
    back = spark.read.parquet(path).select("chunk", "ordinal", "batch_id", F.input_file_name().alias("file")).collect()
    assert sorted(r.ordinal for r in back) == list(range(100))
    assert all(int(r.chunk) == r.batch_id // 5 for r in back)
    folders = sorted({r.file.rsplit("/", 2)[1] for r in back})
    assert [int(f.removeprefix("chunk=")) for f in folders] == list(range(5))
    by_file = {}
    for r in scan_with_position(spark, path).select("ordinal", "_src_file", "_src_row").collect():
        by_file.setdefault(r[1], []).append((r[2], r[0]))
    assert all([o for _, o in sorted(rows)] == sorted(o for _, o in rows) for rows in by_file.values())


def test_count_of_a_sub_list(spark):
    from chatmill.functions.arrays import count_subarray
    cases = [([1, 1, 1, 1], [1, 1], 3), ([1, 2, 1, 2, 1], [1, 2, 1], 2), ([], [1], 0), ([1], [1, 1], 0), ([5, 5], [5], 2), (None, [1], 0), ([1, 2], [], 0), ([3, 0, 7, 0, 7], [0, 7], 2)]
    for ids, needle, want in cases:
        df = spark.createDataFrame([(ids,)], "ids array<int>")
        assert df.select(count_subarray("ids", needle)).first()[0] == want


def test_marker_tally(spark):
    from chatmill.operators.encode import marker_tally
    df = spark.createDataFrame([("a", [0, 7, 1, 0, 7]), ("a", [0, 7]), ("a", [0, 7]), ("b", []), ("b", None)], "source string, input_ids array<int>")
    assert sorted(map(tuple, marker_tally(df, [0, 7], ["source"]).collect())) == [("a", 1, 2), ("a", 2, 1), ("b", 0, 2)]


def test_pad_lengths_3_1(spark):
    path = scratch_path(spark, "pad2")
    spark.createDataFrame([([5, 5, 5], [1, 1, 1], [5, 5, 5]), ([6], [1], [6])],
                          "input_ids array<int>, attention_mask array<int>, labels array<int>").coalesce(1).write.parquet(path)
    out = pad_batches(scan_with_position(spark, path), 2, 0, 8).orderBy("ordinal").collect()
    assert [r.width for r in out] == [8, 8]
    assert out[1].input_ids == [6] + [0] * 7 and out[1].labels == [6] + [-100] * 7


def test_encode_with_vocab_narrow(spark):
    df = spark.createDataFrame([(1, ["b", "a", "zz", "user"]), (2, []), (3, None)], "k int, tokens array<string>")
    vocab = V.fit_vocab(spark.createDataFrame([(["b", "a", "b", "user"],)], "tokens array<string>"), "tokens", 10)
    out = V.encode_with_vocab(df, vocab, "tokens", unk_id=-1, max_vocab=10)
    got = {r.k: r.input_ids for r in out.collect()}
    assert got[1] == [8, 9, -1, 6] and got[2] == [] and got[3] == []
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_count_threshold_matches_sort(spark, monkeypatch):
    import random
    monkeypatch.setattr(V, "_FANOUT", 3)          # force several narrowing passes
    rnd = random.Random(5)
    counts = [rnd.choice([1, 1, 1, 2, 3, 5, 8, 13, 40, 41, 300, 1000, 1001]) for _ in range(400)]
    df = spark.createDataFrame([(f"t{i}", c) for i, c in enumerate(counts)], "token string, count long")
    desc = sorted(counts, reverse=True)
    for k in (1, 2, 7, 50, 133, 399, 400, 1000):
        assert V.count_threshold(df, k) == (desc[k - 1] if k <= len(desc) else 1)
