"""Terms of text quality, latent-semantic vectors and neighbour votes (task side)."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from .shingle_sets import mixed

#: Hashed terms: word shapes and rates, then words, then pairs of words.
SHAPES, WORDS, PAIRS = 1024, 2048, 1024
DIMS = SHAPES + WORDS + PAIRS
#: Length of the words' part of a vector, where that of the shapes is 1.
WORD_WEIGHT = 0.5
#: Values are kept in steps of this.
_STEP = 1 / 30
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_EDGES = b""".,;:!?"'()[]"""
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Letters to a or A, digits to 0; bytes of other scripts count as small letters.
_SHAPE = bytes(48 if 48 <= c < 58 else 65 if 65 <= c < 91 else 97 if 97 <= c < 123 or c >= 128 else c for c in range(256))
_RUN = re.compile(rb"(.)\1+", re.S)


def _term(name: bytes) -> int:
    return xxhash.xxh64_intdigest(name) % SHAPES


def counts_of(text: str | None, cache: dict[bytes, int]) -> dict[int, float]:
    """Word shapes (letter case, digits, signs), and how much words, lines and
    signs repeat, as weighted terms."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    out: Counter = Counter()
    if len(cache) > 50_000:
        cache.clear()
    words = raw.split()
    for shape, n in Counter(raw.translate(_SHAPE).split()).items():
        if shape not in cache:
            cache[shape] = _term(b"s" + _RUN.sub(rb"\1", shape)[:12])
        out[cache[shape]] += n
    n = max(1, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    rates = {b"words": 1 - len(set(words)) / n, b"lines": 1 - len(set(lines)) / max(1, len(lines)),
             b"signs": 1 - sum(map(str.isalnum, text or "")) / max(1, len(text or "") - (text or "").count(" ")), b"length": min(1.0, len(raw) / n / 20)}
    result = {t: float(np.log1p(c * 100 / n)) for t, c in out.items()}
    for name, rate in rates.items():
        t = _term(b"r" + name + b"%d" % int(rate * 10))
        result[t] = result.get(t, 0.0) + 3.0
    return result


def word_terms(text: str | None, cache: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words (A-Z lower-cased, without signs at their ends) and pairs of
    neighbours, and how often they stand, as weighted terms."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if len(cache) > 200_000:
        cache.clear()
    for w in words:
        if w not in cache:
            cache[w] = xxhash.xxh64_intdigest(w.strip(_EDGES))
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    pairs = mixed(h[:-1] * _FACTOR + h[1:])
    terms = np.concatenate([SHAPES + mixed(h) % np.uint64(WORDS), SHAPES + WORDS + pairs % np.uint64(PAIRS)]).astype(np.int64)
    counts = np.bincount(terms, minlength=DIMS)
    terms = np.flatnonzero(counts)
    return terms, np.log1p(counts[terms] * 100 / max(1, len(words)))


def extractor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) -> (id, terms, values): a 16-bit number and steps of ``_STEP`` a term."""
    cache: dict[bytes, int] = {}
    words: dict[bytes, int] = {}
    for batch in batches:
        terms, values = [], []
        for text in batch.column(1):
            text = text.as_py()
            c = counts_of(text, cache)
            more, weights = word_terms(text, words)
            terms.append(np.concatenate([np.fromiter(c, np.int64, len(c)), more]).astype("<u2").tobytes())
            values.append(np.clip(np.rint(np.concatenate([np.fromiter(c.values(), float, len(c)), weights]) / _STEP), 1, 255).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.binary()), pa.array(values, pa.binary())], ["id", "terms", "values"])


def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(terms) -> (term, documents), summed over the task."""
    total = np.zeros(DIMS, np.int64)
    for batch in batches:
        total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u2"), minlength=DIMS)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS), pa.int64()), pa.array(total, pa.int64())], ["term", "n"])


def matrix(terms: list[bytes], values: list[bytes], idf: np.ndarray) -> np.ndarray:
    """Tf-idf vectors: the shapes' part of length 1, the words' of ``WORD_WEIGHT``."""
    out = np.zeros((len(terms), DIMS), np.float32)
    for i, (t, v) in enumerate(zip(terms, values)):
        t = np.frombuffer(t, "<u2")
        out[i, t] = np.frombuffer(v, np.uint8) * np.float32(_STEP) * idf[t]
    out[:, :SHAPES] = unit(out[:, :SHAPES])
    out[:, SHAPES:] = unit(out[:, SHAPES:]) * np.float32(WORD_WEIGHT)
    return out


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def latent_axes(x: np.ndarray, rank: int, rounds: int = 6) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration with half as
    many vectors more from a fixed start."""
    wide = min(rank + rank // 2, *x.shape) if x.size else 0
    if not wide:
        return np.zeros((x.shape[1], rank), np.float32)
    y = x @ np.random.default_rng(6).normal(size=(x.shape[1], wide)).astype(np.float32)
    for _ in range(rounds):
        y, _ = np.linalg.qr(y)
        y, _ = np.linalg.qr(x.T @ y)
        y = x @ y
    _, _, vectors = np.linalg.svd(np.linalg.qr(y)[0].T @ x, full_matrices=False)
    return np.ascontiguousarray(vectors[:rank].T, dtype=np.float32)


def voter(model, k: int, power: float, block: int = 256):
    """(id, terms, values) -> (id, score): cosines with every labelled vector in
    blocks of documents; the k nearest vote with their similarity's power."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, axes, known, labels = model.value
        prior = float((labels.sum() + 0.5) / (len(labels) + 1))
        for batch in batches:
            terms, values = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            scores = np.full(len(terms), prior)
            for i in range(0, len(terms) if len(known) else 0, block):
                near = unit(matrix(terms[i:i + block], values[i:i + block], idf) @ axes) @ known.T
                top = np.argpartition(near, max(0, near.shape[1] - k), axis=1)[:, -k:]
                weight = np.maximum(np.take_along_axis(near, top, 1), 0).astype(np.float64) ** power
                total = weight.sum(1)
                scores[i:i + block] = np.where(total > 0, (weight * labels[top]).sum(1) / np.maximum(total, 1e-300), prior)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.clip(scores, 0, 1), pa.float64())], ["id", "score"])
    return run
