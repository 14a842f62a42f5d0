import zlib

import xxhash

from chatmill.llm import sharding


def _signed(x):
    return x - 2**64 if x >= 2**63 else x


def _draw(key, i):
    seed = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)
    return xxhash.xxh64_intdigest(i.to_bytes(4, "little", signed=True), seed)


def _jump(key, n):
    b, j, i = -1, 0, 0
    while j < n:
        b, i = j, i + 1
        j = (b + 1) * 2**32 // ((_draw(key, i) >> 32) + 1)
    return b


def test_against_brute_force(spark):
    rows = [(i * 7919 - 50_000, None if i % 50 == 0 else f"text {i % 40} é" * (i % 5)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS shard", "1 AS slot", "2 AS _cell")
    got = sharding.shard_documents(docs, 24).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
    text = dict(rows)
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert (r.shard, r.grown_shard) == (_jump(r.doc_id, 24), _jump(r.doc_id, 25))
        assert r.grown_shard in (r.shard, 24)
    for s in range(24):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert max(sum(r.shard == s for r in got) for s in range(24)) < 3 * 600 / 24


def test_nulls_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a"), (None, None), (5, "b"), (5, "b"), (5, "b")], "doc_id long, text string")
    got = sharding.shard_documents(docs, 3).collect()
    assert len(got) == 5 and len({r.shard for r in got if r.doc_id == 5}) == 1
    for s in range(3):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert sharding.shard_documents(docs.where("doc_id > 9"), 3).count() == 0


def test_no_python_and_no_wide_window(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = sharding.shard_documents(docs, 24)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan
