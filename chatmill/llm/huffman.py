"""Canonical length-limited Huffman codes and blocks of coded ids (task side).

A block holds the ids of some documents, each coded from a byte on, the first
bit highest. Checkpoints give the bit offset of every 512th id of a document,
so decoding starts at any of them; a block is decoded from all its checkpoints
side by side, each step looking 16 bits up in one table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LIMIT, STRIDE, BLOCK_IDS = 16, 512, 1 << 20


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal lengths up to ``limit`` by package-merge; 0 for unused symbols."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) > 1 << limit:
        raise ValueError("more symbols than codes of that length")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    leaf_first, pairs = [], np.empty(0)
    for _ in range(limit):
        both = np.concatenate([weights, pairs])
        place = np.argsort(both, kind="stable")
        leaf_first.append(place < len(weights))
        both = both[place]
        pairs = both[:len(both) // 2 * 2].reshape(-1, 2).sum(1)
    take = 2 * len(order) - 2
    for is_leaf in reversed(leaf_first):
        leaves = int(is_leaf[:take].sum())
        lengths[order[:leaves]] += 1
        take = 2 * (take - leaves)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The codes: ascending by (length, symbol)."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    steps = np.left_shift(1, LIMIT - lengths[order].astype(np.int64))
    codes[order] = (np.cumsum(steps) - steps) >> (LIMIT - lengths[order].astype(np.int64))
    return codes


def decoding_table(lengths: np.ndarray) -> np.ndarray:
    """For each 16 bits, the symbol they begin with, and above it the length."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    table = np.zeros(1 << LIMIT, np.uint64)
    filled = np.repeat(order.astype(np.uint64) | (lengths[order].astype(np.uint64) << np.uint64(40)), np.left_shift(1, LIMIT - lengths[order].astype(np.int64)))
    table[:len(filled)] = filled
    return table


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The coded ids, padded to a byte, and the bit offset of every 512th."""
    payload, _, checkpoints = pack_many(ids, np.array([len(ids)]), lengths, codes)
    return payload, checkpoints


def pack_many(ids: np.ndarray, counts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Of documents of ``counts`` ids each: the coded ids, each document padded
    to a byte, the bytes of each, and the bit offset in its document of every 512th id."""
    size = lengths[ids].astype(np.int64)
    if (size == 0).any():
        raise ValueError("an id without a code")
    ends = np.append(0, np.cumsum(size))
    starts = np.cumsum(counts) - counts
    first = ends[starts]
    n_bytes = (ends[starts + counts] - first + 7) // 8
    at = ends[:-1] + np.repeat((np.cumsum(n_bytes) - n_bytes) * 8 - first, counts)
    value = codes[ids].astype(np.int64) << (32 - (at & 15) - size)
    words = int(n_bytes.sum() + 1) // 2 + 1
    out = np.bincount(at >> 4, value >> 16, words) + np.bincount((at >> 4) + 1, value & 0xFFFF, words)
    stops = (counts + STRIDE - 1) // STRIDE
    marks = np.repeat(starts - (np.cumsum(stops) - stops) * STRIDE, stops) + np.arange(stops.sum()) * STRIDE
    return out.astype(">u2").tobytes()[:int(n_bytes.sum())], n_bytes, ends[marks] - np.repeat(first, stops)


def unpack(payload: bytes, checkpoints: np.ndarray, counts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The ids of all stretches, each ``counts`` ids from a checkpoint on."""
    raw = np.frombuffer(payload + b"\0\0\0", np.uint8).astype(np.uint32)
    window = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    out = np.zeros(int(counts.sum()), np.uint32)
    order = np.argsort(-counts, kind="stable")
    at, place, left = checkpoints[order].astype(np.int64), (np.cumsum(counts) - counts)[order], -counts[order]
    for step in range(int(counts.max(initial=0))):
        going = int(np.searchsorted(left, -step, "left"))     # stretches of more than `step` ids come first
        at = at[:going]
        entry = table[(window[at >> 3] >> (8 - (at & 7))) & 0xFFFF]
        out[place[:going] + step] = entry & np.uint64(0xFFFFFFFF)
        at = at + (entry >> np.uint64(40)).astype(np.int64)
    return out


def stretches(sizes: np.ndarray) -> np.ndarray:
    """Ids from each checkpoint on, for documents of these sizes."""
    full = (sizes + STRIDE - 1) // STRIDE
    out = np.full(int(full.sum()), STRIDE, np.int64)
    last = np.cumsum(full)[full > 0] - 1
    out[last] = sizes[full > 0] - (full[full > 0] - 1) * STRIDE
    return out


def packed_counts(counts: np.ndarray) -> bytes:
    """Counts by id, as pairs (id, count) of those that occur."""
    used = np.flatnonzero(counts)
    return np.stack([used, counts[used]], 1).astype("<i8").tobytes()


def counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(packed counts) -> (token, n), summed over the task."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        for row in batch.column(0):
            token, n = np.frombuffer(row.as_py(), "<i8").reshape(-1, 2).T
            if len(token) and token[-1] >= len(total):
                total = np.append(total, np.zeros(token[-1] + 1 - len(total), np.int64))
            total[token] += n
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["token", "n"])


BLOCK_FIELDS = "range long, seq long, n_ids long, doc_ids binary, lengths binary, checkpoints binary, payload binary"


def binaries(payload: bytes | np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Rows of bytes that lie one after another."""
    ends = pa.py_buffer(np.append(0, np.cumsum(sizes)).astype(np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, ends, pa.py_buffer(payload)]).cast(pa.binary())


def coder(code):
    """(range, id, ids) -> (range, id, n_ids, checkpoints, payload) of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = np.frombuffer(code.value, np.uint8)
        codes = canonical(lengths)
        for batch in batches:
            counts = pc.binary_length(batch.column(2)).to_numpy().astype(np.int64) // 4
            # some documents together, about a block's ids
            for rows in np.split(np.arange(len(counts)), np.flatnonzero(np.diff(np.cumsum(counts) // BLOCK_IDS)) + 1):
                if len(rows):
                    part, own = batch.slice(rows[0], len(rows)), counts[rows]
                    payload, n_bytes, checkpoints = pack_many(np.frombuffer(b"".join(part.column(2).to_pylist()), "<u4"), own, lengths, codes)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), pa.array(own), binaries(checkpoints.astype("<u8"), (own + STRIDE - 1) // STRIDE * 8), binaries(payload, n_bytes)],
                        ["range", "id", "n_ids", "checkpoints", "payload"])
    return run


def block_writer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Coded documents in order -> blocks of whole documents."""
    held: list[tuple] = []
    part, seq, size = None, 0, 0

    def block() -> pa.RecordBatch:
        begin = np.cumsum([0, *[len(p) for *_, p in held[:-1]]], dtype=np.int64) * 8
        checkpoints = np.concatenate([np.frombuffer(c, "<u8").astype(np.int64) + b for b, (_, _, c, _) in zip(begin, held)])
        row = [[part], [seq], [sum(n for _, n, _, _ in held)], [np.array([i for i, *_ in held], "<i8").tobytes()],
               [np.array([n for _, n, _, _ in held], "<u8").tobytes()], [checkpoints.astype("<u8").tobytes()], [b"".join(p for *_, p in held)]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, [pa.int64()] * 3 + [pa.binary()] * 4)],
                                          ["range", "seq", "n_ids", "doc_ids", "lengths", "checkpoints", "payload"])

    for batch in batches:
        for where, name, n, checkpoints, payload in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (where != part or size + n > BLOCK_IDS):
                yield block()
                held, seq, size = [], seq + 1, 0
            if where != part:
                part, seq = where, 0
            held.append((name, n, checkpoints, payload))
            size += n
    if held:
        yield block()


def block_reader(code):
    """(first, blocks) -> (id, start, n_tokens, ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoding_table(np.frombuffer(code.value, np.uint8))
        for batch in batches:
            for first, names, lengths, checkpoints, payload in zip(*(c.to_pylist() for c in batch.columns)):
                sizes = np.frombuffer(lengths, "<u8").astype(np.int64)
                ids = unpack(payload, np.frombuffer(checkpoints, "<u8"), stretches(sizes), table).astype("<u4")
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(names, "<i8"), pa.int64()), pa.array(first + ends - sizes, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array([ids[e - s:e].tobytes() for s, e in zip(sizes, ends)], pa.binary())], ["id", "start", "n_tokens", "ids"])
    return run
