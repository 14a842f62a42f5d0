import random

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from chatmill.llm import bpe, bpe_model  # noqa: E402
from chatmill.llm.queries import vocabulary  # noqa: E402

ODD = ["", None, " ", "  ", "\n\n", "a  b", " x \n y", "  z", "<|endoftext|> a<|endoftext|>", "don't we'll", "日本語 ☃🙂", "a b \u0085", "\x00\x1c \x1f"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


@pytest.fixture(scope="module")
def model():
    with open(vocabulary(), encoding="utf-8") as f:
        return bpe_model.Vocabulary(f.read())


def test_same_ids_as_the_library(library, model):
    rnd = random.Random(2)
    parts = list("ab  \n\t'stre1 2.!é中🙂　 _-") + ["<|endoftext|>", "  ", "'ll", " the", "ing", "aaaa", "\u0085", "\x1c"]
    chunks = bpe_model.ChunkEncoder(lambda cs: [np.array(model.encode(c), np.int32).tobytes() for c in cs])
    for _ in range(4_000):
        s = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        want = library.encode(s, add_special_tokens=False).ids
        assert model.encode(s) == want and chunks.encode(s).tolist() == want


def test_every_token_is_its_own_encoding_and_long_words_pass(library, model):
    for token in random.Random(4).sample(range(50_256), 3_000):
        assert model.encode_word(model.bytes_of[token]) == [token]
    for word in ("a" * 5_000, "ab" * 3_000, "lol" * 999):
        assert model.encode(word) == library.encode(word, add_special_tokens=False).ids


def test_operator(spark, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "twin"), (3, "twin"), (None, "no id"), (99, "long text " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS id", "3 AS decoded")
    got = bpe.encode_decode(docs, vocabulary()).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, library.decode(ids, skip_special_tokens=False), ids))
    assert sorted([(r.doc_id, r.decoded, r.ids) for r in got], key=key) == sorted(want, key=key)
    assert bpe.encode_decode(docs.where("false"), vocabulary()).count() == 0
