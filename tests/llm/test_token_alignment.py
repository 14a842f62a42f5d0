"""op12 against plain merges of the libraries' own encodings."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from chatmill.llm import cross_tokenizer, queries, token_alignment
from chatmill.llm.bpe_model import byte_letters

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", "a", " ", "  two  spaces \n\n and\ttabs ", "Ünïcödé wörds, 北京 と 東京 🙂🙂!", "a▁b stays out", "<|endoftext|> and <s> are text", "it's 12345 o'clock",
         "x" * 3000, "word " * 2000, "no break   em", "\x00nul \x1cfs", "ends with space ", "ﬁ ligature é é"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_FILE)


def plain(libraries, text):
    """(a ids, b ids, groups, links) of one text, whole."""
    a, b = libraries
    if not text:
        return [], [], "", []
    letters = {c: x for x, c in byte_letters().items()}
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_raw = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
    b_raw = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    if not b"".join(a_raw) == b"".join(b_raw) == (" " + text).encode():
        return [], [], "", []
    ends = [dict(zip(np.cumsum([len(x) for x in raw]).tolist(), range(len(raw)))) for raw in (a_raw, b_raw)]
    groups, links, i, j = [], [], 0, 0
    for end in sorted(ends[0].keys() & ends[1].keys()):
        x, y = ends[0][end], ends[1][end]
        groups.append(",".join(map(str, a_ids[i:x + 1])) + "|" + ",".join(map(str, b_ids[j:y + 1])))
        links.append((a_ids[x], b_ids[y]))
        i, j = x + 1, y + 1
    return a_ids, b_ids, ";".join(groups), links


def expected(libraries, rows):
    found = [(i, plain(libraries, t)) for i, t in rows]
    counts = Counter(x for _, (_, _, _, links) in found for x in links)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return Counter((i, len(a), len(b), len(links), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(groups.encode()).hexdigest() if a else "") for i, (a, b, groups, links) in found)


FIELDS = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def _run(spark, tmp_path, rows, schema="doc_id long, text string"):
    spark.createDataFrame(rows, schema).selectExpr("*", "1 AS key", "2 AS pairs", "'x' AS n_a").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return Counter(tuple(r[f] for f in FIELDS) for r in queries.op12_token_alignment(spark, str(tmp_path)).collect())


def test_against_plain_merge(spark, tmp_path, libraries):
    rng = random.Random(5)
    alphabet = ["the", "ing", "é", "北", " ", "  ", "\n", ".", "12", "Straße", "▁", "x", "'ll"]
    rows = [(None if i == 3 else i % 30, t) for i, t in enumerate(TEXTS + ["".join(rng.choice(alphabet) + rng.choice(["", " "]) for _ in range(rng.randrange(40))) for _ in range(120)])]
    assert _run(spark, tmp_path, rows) == expected(libraries, rows)


def test_pairs_that_are_not_broadcast(spark, tmp_path, libraries, monkeypatch):
    monkeypatch.setattr(cross_tokenizer, "HOT_PAIRS", 20)
    rows = list(enumerate(TEXTS))
    assert _run(spark, tmp_path, rows) == expected(libraries, rows)


def test_lanes_give_the_same(libraries, monkeypatch):
    with open(A_FILE) as f, open(B_FILE, "rb") as g:
        tokenizers = token_alignment.Tokenizers(f.read(), g.read())
    whole = token_alignment.align(tokenizers, TEXTS)
    monkeypatch.setattr(token_alignment, "LANE", 3)
    monkeypatch.setattr(token_alignment, "WINDOW", 2)
    for (n_a, n_b, n, groups, pairs), (m_a, m_b, m, others, more), text in zip(whole, token_alignment.align(tokenizers, TEXTS), TEXTS):
        assert (n_a, n_b, n, groups, pairs.tolist()) == (m_a, m_b, m, others, more.tolist())
        assert groups.decode() == plain(libraries, text)[2]


def test_files_whose_ids_do_not_follow_the_merges_use_the_library(libraries):
    """The same vocabulary with two merged tokens' ids swapped."""
    with open(A_FILE) as f, open(B_FILE, "rb") as g:
        spec, model = json.load(f), g.read()
    vocab = spec["model"]["vocab"]
    vocab["Ġt"], vocab["Ġa"] = vocab["Ġa"], vocab["Ġt"]
    tokenizers = token_alignment.Tokenizers(json.dumps(spec), model)
    own = Tokenizer.from_str(json.dumps(spec))
    own.encode_special_tokens = True
    for text in TEXTS:
        if text and "▁" not in text:
            assert tokenizers.encode(text)[0].tolist() == own.encode(" " + text, add_special_tokens=False).ids


def test_empty_table(spark, tmp_path):
    assert not _run(spark, tmp_path, [])
