"""Task-side functions of near-duplicate detection: shingle sets, min-max
signatures and exact comparison, on numpy arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_CACHED_WORDS, _CACHED_SETS, _ROWS = 200_000, 64, 4096


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, size: int, cache: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles. Words are what ASCII
    white space parts, A-Z lower-cased; fewer than ``size`` words are one
    shingle; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    if len(cache) > _CACHED_WORDS:
        cache.clear()
    for w in words:
        if w not in cache:
            cache[w] = xxhash.xxh64_intdigest(w)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    acc = np.full(len(words) - width + 1, width, np.uint64)
    for j in range(width):
        acc = mixed(acc * _FACTOR + h[j:j + len(acc)])
    return np.unique(acc)


def signature(values: np.ndarray, factors: np.ndarray, flips: np.ndarray) -> np.ndarray:
    """Minimum and maximum of every permutation, in bounded blocks."""
    low, high = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64), np.zeros(len(factors), np.uint64)
    for i in range(0, len(values), _ROWS):
        block = (values[i:i + _ROWS, None] ^ flips) * factors
        np.minimum(low, block.min(0), out=low)
        np.maximum(high, block.max(0), out=high)
    return np.stack([low, high], 1)


def band_keys(sig: np.ndarray, perms: int) -> np.ndarray:
    """A 64-bit key of each band: the minima and maxima of ``perms`` permutations."""
    rows = sig.reshape(-1, 2 * perms)
    key = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for j in range(rows.shape[1]):
        key = mixed(key * _FACTOR + rows[:, j])
    return key.view(np.int64)


def signer(size: int, bands: int, perms: int):
    """(id, text, h) -> (id, shingles, their digest, band keys, h)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.default_rng(20)
        factors = random.integers(0, 2**64, bands * perms, np.uint64) | np.uint64(1)
        flips = random.integers(0, 2**64, bands * perms, np.uint64)
        cache: dict[bytes, int] = {}
        for batch in batches:
            counts, digests, keys = [], [], []
            for text in batch.column(1).to_pylist():
                values = shingle_set(text, size, cache)
                counts.append(len(values))
                digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None)
                keys.append(band_keys(signature(values, factors, flips), perms) if len(values) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64())), batch.column(2)],
                ["id", "n_shingles", "digest", "bands", "h"])
    return run


def gram_lister(size: int):
    """(node, text) -> (node, size of its set, shingle), a row a shingle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                nodes = batch.column(0)[at:at + 64].to_numpy(zero_copy_only=False)
                sets = [shingle_set(t, size, cache).view(np.int64) for t in batch.column(1)[at:at + 64].to_pylist()]
                n = np.array([len(x) for x in sets], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(nodes, n)), pa.array(np.repeat(n, n)), pa.array(np.concatenate(sets))], ["node", "size", "shingle"])
    return run


#: Sizes are told apart in classes that grow by this factor.
SIZE_STEP = 1.04


def size_class(n: np.ndarray | int):
    return np.floor(np.log(np.maximum(n, 1)) / np.log(SIZE_STEP)).astype(np.int64)


def prefixer(percent: int):
    """(node, size, shared [(n, shingle)]) -> (key, node, filed): where a node is
    filed, as the smaller one of a pair, and where it looks for smaller ones.

    Shingles stand in order of (n, shingle), behind the node's own. If the
    rarest common one of a pair stands at place i (from 1), the overlap is at
    most size - i + 1, and has to be percent * (both sizes) / (100 + percent).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[list[np.ndarray]] = []
            for i in range(batch.num_rows):
                node, size, shared = batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), batch.column(2)[i].values
                n, shingles = shared.field(0).to_numpy(zero_copy_only=False), shared.field(1).to_numpy(zero_copy_only=False)
                shingles = shingles[np.lexsort((shingles, n))]
                overlap = len(shingles) - np.arange(len(shingles))                  # what the rest can hold
                partner = overlap * (100 + percent) // percent - size               # and the largest partner's size
                least = -(-size * percent // 100)
                filed = shingles[partner >= size]
                looks = np.flatnonzero(partner >= least)
                low, high = size_class(least), size_class(np.minimum(partner[looks], size))
                times = high - low + 1
                classes = low + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                keys = [_key(filed, np.full(len(filed), size_class(size))), _key(np.repeat(shingles[looks], times), classes)]
                both = len(filed) + len(classes)
                held.append([np.concatenate(keys), np.full(both, node, np.int64), np.arange(both) < len(filed)])
                if len(held) >= 256 or both >= 1 << 16 or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], ["key", "node", "filed"])
                    held = []
    return run


def _key(shingles: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return mixed(shingles.view(np.uint64) * _FACTOR + classes.astype(np.uint64)).view(np.int64)


def comparer(size: int, percent: int):
    """Keeps the pairs (a, b, text_a, text_b) whose full sets are alike."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        sets: dict[str, np.ndarray] = {}

        def of(text: str) -> np.ndarray:
            if text not in sets:
                if len(sets) >= _CACHED_SETS:
                    sets.clear()
                sets[text] = shingle_set(text, size, cache)
            return sets[text]

        for batch in batches:
            a, b, ta, tb = (c.to_pylist() for c in batch.columns)
            keep = []
            for i in range(len(a)):
                x, y = of(ta[i]), of(tb[i])
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both and 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], ["a", "b"])
    return run
