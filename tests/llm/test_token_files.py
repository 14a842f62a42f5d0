import itertools
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chatmill.llm import bpe_model, huffman, token_files
from chatmill.session import scratch_path

P = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from chatmill.llm.queries import vocabulary  # noqa: E402


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=3_000), st.integers(0, 5))
def test_round_trip_of_a_block(ids, skew):
    ids = np.array([i >> (i % (skew + 1)) for i in ids], np.int64)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=42))
    payload, checkpoints = huffman.pack(ids, lengths, huffman.canonical(lengths))
    got = huffman.unpack(payload, checkpoints, huffman.stretches(np.array([len(ids)])), huffman.decoding_table(lengths))
    assert got.tolist() == ids.tolist()


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(1, 1_000), min_size=2, max_size=5))
def test_lengths_are_optimal_under_the_limit(counts):
    counts, limit = np.array(counts), 3
    got = huffman.code_lengths(counts, limit).astype(int)
    best = min(sum(c * n for c, n in zip(counts, ls)) for ls in itertools.product(range(1, limit + 1), repeat=len(counts)) if sum(2.0**-n for n in ls) <= 1)
    assert sum(2.0**-n for n in got) <= 1 and got.max() <= limit and (counts * got).sum() == best


def test_steep_counts_stay_within_the_limit():
    lengths = huffman.code_lengths(np.array([2**i for i in range(50)]))
    assert lengths.max() == huffman.LIMIT and sum(2.0**-int(n) for n in lengths) <= 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=1_200), min_size=1, max_size=6))
def test_documents_packed_together(docs):
    docs = [np.array(d, np.int64) for d in docs]
    lengths = huffman.code_lengths(np.bincount(np.concatenate(docs), minlength=42))
    codes = huffman.canonical(lengths)
    payload, n_bytes, checkpoints = huffman.pack_many(np.concatenate(docs), np.array([len(d) for d in docs]), lengths, codes)
    alone = [huffman.pack(d, lengths, codes) for d in docs]
    assert payload == b"".join(p for p, _ in alone) and n_bytes.tolist() == [len(p) for p, _ in alone]
    assert checkpoints.tolist() == [c for _, own in alone for c in own.tolist()]


PARTS = ["the", "The", "été", "Ÿž", "×", "don't", "'s", "'", "it's", ".", ",", "...", "(a)", "12", "3a", "a1", "\n", "\n\n", "\t", "\r\n", " ", "  ", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "\u2003",
         "\u3000", "\u200b", "\ufeff", "\x00", "\x01", "\x7f", "ß", "日本", "Ж", "٣", "²", "ª", "🙂", "e\u0301", "<|endoftext|>", "<|end", "|>", "-", "_", "x-y", "É.", "\n'll"]


def column_encoder(most=1_000_000):
    model = Tokenizer.from_file(vocabulary())
    lengths = np.zeros(model.get_vocab_size(), np.int64)
    for token, i in model.get_vocab().items():
        lengths[i] = len(token)
    calls = []
    library = bpe_model.library_ids(model, lengths)

    def encode_many(texts, kind):
        calls.append(texts.to_pylist())
        return library(texts, kind)
    return model, bpe_model.ColumnEncoder(encode_many, ["<|endoftext|>"], most), calls


MODEL, ENCODER, _ = column_encoder()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=9).map("".join) | st.lists(st.sampled_from(PARTS), max_size=9).map(" ".join), min_size=1, max_size=5))
def test_columns_are_encoded_as_the_library_does(texts):
    rows, _ = ENCODER.encode(pa.array(texts, pa.string()), 0)
    assert [np.frombuffer(r, "<u4").tolist() for r in rows.to_pylist()] == [[*MODEL.encode(t, add_special_tokens=False).ids, 0] for t in texts]


def test_white_space_is_python_s():
    white = pa.array([chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000], pa.string())
    found = pc.match_substring_regex(white, bpe_model.ColumnEncoder._WHITE).to_numpy(zero_copy_only=False)
    assert {c for c, f in zip(white.to_pylist(), found) if f} == {c for c in white.to_pylist() if c.isspace()}


def test_pieces_are_encoded_once_and_memory_is_bounded():
    """A word with other marks around it goes to the library once, also in a later column; what is remembered is bounded."""
    model, encoder, calls = column_encoder(most=50)
    for text in ("a word, and word. the word; (word) été.\nword", "a more, more. more word!"):
        encoder.encode(pa.array([text]), 0)
    assert sum(c.count(" word") for c in calls) == 1 and sum(c.count(" more") for c in calls) == 1
    for i in range(40):
        text = " ".join(f"x{i} w{j}." for j in range(i, i + 10))
        assert np.frombuffer(encoder.encode(pa.array([text]), 0)[0][0].as_py(), "<u4").tolist() == [*model.encode(text).ids, 0]
        assert len(encoder.chunks.strings) <= 50 + 20 and len(encoder.pieces.strings) <= 50 + 20


def test_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "DOCS_PER_RANGE", 20)
    monkeypatch.setattr(huffman, "BLOCK_IDS", 300)
    rows = [(i * 13 % 211 - 40, f"text {i} " * (i % 30)) for i in range(211)] + [(500, None), (501, ""), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS range", "2 AS ids", "3 AS seq")
    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(docs, vocabulary(), path)
    got = {r.doc_id: r for r in token_files.read_tokens(spark, path).collect()}
    library, start = Tokenizer.from_file(vocabulary()), 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        r = got.pop(i)
        assert (r.start, r.n_tokens, zlib.crc32(r.ids)) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got
    blocks = [(r.f, r.doc_ids) for r in spark.read.parquet(f"{path}/blocks").selectExpr("_metadata.file_name AS f", "doc_ids").collect()]
    order = [i for f in sorted({f for f, _ in blocks}) for g, d in blocks if g == f for i in np.frombuffer(d, "<i8")]
    assert order == sorted(order) and len(blocks) > 11


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a")], "doc_id long, text string")
    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(docs, vocabulary(), path)
    assert sorted(r.start for r in token_files.read_tokens(spark, path).collect()) == [0, 2, 4]
    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(docs.where("false"), vocabulary(), path)
    assert token_files.read_tokens(spark, path).count() == 0
