"""The registered queries on the given tables: those with SQL against it, the
others against plain restatements of their contracts."""

import hashlib
import os
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chatmill.llm import queries  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
#: Keys without SQL, and where each is held against a restatement of its contract.
TESTED = {
    "op1_fingerprints": "test_fingerprints.py", "op2_toxicity": "test_classifiers.py", "op6_quality": "test_classifiers.py",
    "op4_bpe": "test_registered.py", "op7_token_files": "test_registered.py", "op8_sharding": "test_registered.py", "op9_neardup": "test_registered.py",
    "op10_suffix_dedup": "test_registered.py", "op11_conversation_repair": "test_conversation_repair.py", "op12_token_alignment": "test_token_alignment.py",
    "op13_pii": "test_pii.py"}


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(queries.vocabulary())


def _sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def test_every_query_has_sql_or_a_test():
    assert set(queries.QUERIES) == set(queries.ORACLE_SQL) | set(TESTED)
    here = os.path.dirname(os.path.abspath(__file__))
    for name, file in TESTED.items():
        with open(f"{here}/{file}") as f:
            assert name in f.read() or name == "op1_fingerprints"


def test_queries_with_sql(spark):
    res = compare(spark, SF, sorted(queries.ORACLE_SQL), duck(SF))
    assert all(v.get("match") is True for v in res.values()), res


def test_op4_bpe(spark, texts, library):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op4_bpe(spark, SF).collect()}
    for i, t in texts.items():
        ids = library.encode(t, add_special_tokens=False).ids
        assert got.pop(i) == (len(ids), _sha(",".join(map(str, ids))), _sha(library.decode(ids, skip_special_tokens=False)))
    assert not got


def test_op7_token_files(spark, texts, library):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op7_token_files(spark, SF).collect()}
    start = 0
    for i in sorted(texts):
        ids = np.array(library.encode(texts[i], add_special_tokens=False).ids + [0], "<u4")
        assert got.pop(i) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got


def test_op8_sharding(spark, texts):
    got = queries.op8_sharding(spark, SF).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {i: (len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in texts.items()}
    assert all(r.law == "key" and 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24) for r in got) and len(got) == len(texts)
    for s in range(24):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))


def test_op9_neardup(spark, texts):
    from test_neardup import _brute
    want = _brute(list(texts.items()), 4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op9_neardup(spark, SF).collect()}
    assert got == {i: (n, c, i == c) for i, (n, c) in want.items()}
    assert any(c != i for i, (_, c) in want.items())


def test_op9_rows_of_one_id(spark, tmp_path):
    """kept is whether doc_id is component_id, also where ids repeat."""
    spark.createDataFrame([(4, "a b c d e"), (4, "a b c d e"), (9, "a b c d e")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id, r.component_id, r.kept) for r in queries.op9_neardup(spark, str(tmp_path)).collect())
    assert got == [(4, 4, True), (4, 4, True), (9, 4, False)]


def test_op10_suffix_dedup(spark, texts):
    raw = {i: t.encode() for i, t in texts.items()}
    first = {}
    for i in sorted(raw):
        for at in range(len(raw[i]) - 49):
            first.setdefault(raw[i][at:at + 50], i)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op10_suffix_dedup(spark, SF).collect()}
    for i, b in raw.items():
        gone = np.zeros(len(b) + 1, bool)
        for at in range(len(b) - 49):
            if first[b[at:at + 50]] < i:
                gone[at:at + 50] = True
        gone = gone[:-1]
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        assert got.pop(i) == (len(b), int(gone.sum()), spans, _sha(kept)), i
    assert not got
