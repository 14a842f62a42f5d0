import random

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chatmill.llm import suffix_dedup, suffix_runs


def _brute(rows):
    first, out = {}, []
    for i, t in sorted((i if i is not None else 2**63 - 1, t or "") for i, t in rows):
        b = t.encode()
        for p in range(len(b) - 49):
            first.setdefault(b[p:p + 50], i)
    for i, t in rows:
        b, at = (t or "").encode(), i if i is not None else 2**63 - 1
        g = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < at:
                g[p:p + 50] = b"\1" * 50
        spans = [(k, next((j for j in range(k, len(b)) if not g[j]), len(b))) for k in range(len(b)) if g[k] and (k == 0 or not g[k - 1])]
        out.append((i, len(b), sum(g), spans, bytes(x for x, y in zip(b, g) if not y)))
    return out


@pytest.fixture(autouse=True)
def small_chunks(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 20_000)


def _check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS chunk", "2 AS id", "3 AS a", "4 AS kind")
    got = [(r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[4], r[1])
    assert sorted(got, key=key) == sorted(_brute(rows), key=key)


def test_against_brute_force(spark):
    rnd = random.Random(7)
    text = lambda n: "".join(rnd.choice("abcdé fgh\n") for _ in range(n))
    common = [text(n) for n in (49, 50, 51, 76, 120, 400)]
    rows = []
    for i in range(150):
        t = text(rnd.randint(0, 300))
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randint(0, len(t))
            t = t[:at] + rnd.choice(common) + t[at:]
        rows.append((i, t))
    for i in range(150, 200):                                  # near copies and exact ones
        t = rows[rnd.randrange(150)][1]
        at = rnd.randint(0, len(t))
        rows.append((i, t if i % 4 == 0 else t[:at] + rnd.choice("xyz") + t[at:]))
    rows += [(300 + i, t) for i, t in enumerate(["", None, "a" * 49, "a" * 500, "a" * 700, "ab" * 400, "é" * 60, "é" * 61, "\0" * 80, "\0" * 70, common[4]])]
    rows += [(311, rows[5][1]), (311, rows[5][1]), (312, rows[5][1]), (None, rows[9][1]), (-4, rows[11][1])]
    rnd.shuffle(rows)
    _check(spark, rows)


def test_long_text_over_slices(spark, monkeypatch):
    rnd = random.Random(9)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(30_000))
    _check(spark, [(1, text[10_000:20_000]), (2, text), (3, text[5_000:])])


def test_empty_table_and_whole_characters(spark):
    docs = spark.createDataFrame([(1, "é" * 40, 40, 7), (2, "è" + "é" * 39 + "!", 41, 8)], "doc_id long, text string, n_chars long, kept long")
    assert suffix_dedup.remove_repeats(docs.where("false")).count() == 0
    out = suffix_dedup.without_repeats(docs)
    assert out.columns == docs.columns and suffix_dedup.without_repeats(docs.where("false")).count() == 0
    got = {r.doc_id: (r.text, r.n_chars, r.kept) for r in out.collect()}
    assert got == {1: ("é" * 40, 40, 7), 2: ("è!", 2, 8)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.binary(min_size=suffix_runs.KEY, max_size=suffix_runs.KEY).map(lambda b: bytes(x % 3 for x in b)), max_size=12), max_size=9))
def test_loser_tree_merges_and_knows_prefixes(lists):
    runs = []
    for keys in lists:
        matrix = np.frombuffer(b"".join(sorted(set(keys))), np.uint8).reshape(-1, suffix_runs.KEY)
        lcp = suffix_runs._lcps(matrix)
        runs.append(suffix_runs._run(lcp.tobytes(), matrix[np.arange(suffix_runs.KEY) >= lcp[:, None]].tobytes()))
    got = list(suffix_runs.merge(runs))
    assert [k for _, k, _ in got] == sorted(k for keys in lists for k in set(keys))
    for (_, a, _), (_, b, share) in zip(got, got[1:]):
        assert share == next((i for i in range(len(a)) if a[i] != b[i]), len(a))


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=400).map(lambda b: bytes(x % 2 for x in b)))
def test_every_window_has_its_anchor(data):
    buf = np.frombuffer(data, np.uint8)
    at, _ = suffix_runs.anchors(buf, np.arange(len(buf), 0, -1))
    have = set(at.tolist())
    for p in range(len(buf) - suffix_runs.WIDTH + 1):
        assert any(a in have for a in range(p, p + suffix_runs.BEFORE + 1))


def test_hot_grams_against_brute_force(spark, monkeypatch):
    rnd = random.Random(13)
    text = lambda n: "".join(rnd.choice("abcdefghijkl é") for _ in range(n))
    phrase, passage, tail = text(40), text(120), text(30)
    rows = [(i, text(rnd.randint(0, 120)) + phrase + (tail if i % 5 == 0 else "") + text(rnd.randint(0, 120)) + (passage if i % 3 == 0 else "")) for i in range(300)]
    rows += [(None, rows[7][1] + text(20)), (None, rows[8][1]), (None, text(90) + passage), (7, phrase + passage), (7, phrase + passage), (-1, phrase + tail), (400, phrase), (401, None)]
    rnd.shuffle(rows)
    for most in (0, 3, 100):
        monkeypatch.setattr(suffix_dedup, "HOT_ANCHORS", most)
        _check(spark, rows)


def test_a_phrase_of_all_documents_is_not_one_range():
    rnd = random.Random(17)
    text = lambda n: "".join(rnd.choice("abcdefghijkl ") for _ in range(n))
    phrase, ranges, most = text(60), 8, 50
    number = lambda i: (pa.scalar(i, pa.int64()),)
    chunks = [pa.table({"chunk": [c] * 100, "id": list(range(100 * c, 100 * c + 100)), "text": [text(80) + phrase + text(80) for _ in range(100)]}) for c in range(6)]
    told = pa.concat_tables([suffix_runs.announcer(ranges)(number(c), t) for c, t in enumerate(chunks)])
    buckets = {b: told.filter(pa.compute.equal(told["bucket"], b)) for b in told["bucket"].unique().to_pylist()}
    shared = pa.concat_tables([suffix_runs.matcher(most)(number(b), t) for b, t in buckets.items()])
    runs = pa.concat_tables([suffix_runs.sorter([], ranges)(number(c), t, shared.filter(pa.compute.equal(shared["chunk"], c))) for c, t in enumerate(chunks)]).to_pylist()
    grams = [k[:suffix_runs.GRAM] for r in runs if r["kind"] == 0 for k, _ in suffix_runs._run(r["a"], suffix_runs.zlib.decompress(r["b"]))]
    assert max(map(grams.count, grams)) <= most
    sizes = {}
    for r in runs:
        if r["kind"] == 2:
            sizes[r["bucket"]] = sizes.get(r["bucket"], 0) + len(r["a"]) // 8
    assert len(sizes) == ranges and max(sizes.values()) < 2 * sum(sizes.values()) / ranges


def test_rows_of_one_id_are_dealt_to_many_chunks(spark):
    docs = spark.createDataFrame([(suffix_dedup._LAST_ID, f"text {i}") for i in range(200)], "id long, text string")
    dealt = {r["chunk"] for r in docs.select(suffix_dedup._chunk_of(8).alias("chunk")).collect()}
    assert dealt == set(range(8))


def test_a_gram_whose_order_is_zero_is_an_anchor(monkeypatch):
    hashes = suffix_runs.gram_hashes

    def zero_at_40(buf, *width):
        out = hashes(buf, *width)
        out[40] &= np.uint64(0xFFFFFFFF)
        return out

    monkeypatch.setattr(suffix_runs, "gram_hashes", zero_at_40)
    buf = np.frombuffer(random.Random(3).randbytes(120), np.uint8)
    at, _ = suffix_runs.anchors(buf, np.arange(len(buf), 0, -1))
    assert 40 in at
