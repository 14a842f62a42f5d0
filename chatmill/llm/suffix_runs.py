"""Task-side functions of the repeated-substring operator, on numpy arrays.

Anchors. Of every 27 neighbouring 24-byte grams the one of smallest hash is an
anchor: a 50-byte window holds 27 grams, so equal windows hold the same anchor
at the same place. What lies within a window around an anchor is its context:
the 50 bytes that start at the anchor and the 26 before it, reversed.

Runs. A chunk's contexts, sorted and equal ones merged, are a run; it travels
front-coded (common prefix length, remaining bytes).

Merging. A loser tree merges runs by the prefix that each head shares with the
last winner: a longer one wins unseen, equal ones are compared past it.

Hot grams. What starts at a gram that very many anchors have is not merged, as a
gram is never parted. Every window of 50 bytes around such an anchor is hashed;
a chunk keeps the smallest id of each hash, and these meet by ranges of the hash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH, GRAM = 50, 24
BEFORE = WIDTH - GRAM                     # 26 bytes before an anchor may share a window with it
KEY = WIDTH + BEFORE + 2                  # right context, reversed left context, their true lengths
_SLICE = 1 << 16
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_BITS = 48


def _power(k: int) -> np.uint64:
    return np.uint64(pow(int(_A), k, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B
    return x ^ (x >> np.uint64(29))


def gram_hashes(buf: np.ndarray, width: int = GRAM) -> np.ndarray:
    """64-bit hash of the ``width`` bytes from each position."""
    join = lambda a, la, b, lb: a[:len(a) - lb] * _power(lb) + b[la:la + len(a) - lb]
    h, k = {1: (buf.astype(np.uint64) + np.uint64(1)) * _B}, 1
    while 2 * k <= width:
        h[2 * k] = join(h[k], k, h[k], k)
        k *= 2
    out, have = h[k], k
    while have < width:
        k = 1 << (width - have).bit_length() - 1
        out, have = join(out, have, h[k], k), have + k
    return _mix(out[:max(0, len(buf) - width + 1)])


def window_hashes(buf: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hashes of the windows that start at the ascending ``starts``, by slices."""
    out = np.empty(len(starts), np.uint64)
    for s in range(0, len(buf), _SLICE):
        a, b = np.searchsorted(starts, [s, s + _SLICE])
        if a < b:
            out[a:b] = gram_hashes(buf[s:s + _SLICE + WIDTH - 1], WIDTH)[starts[a:b] - s]
    return out


def _sliding(x: np.ndarray, width: int, of) -> np.ndarray:
    """``of`` (minimum or maximum) over every ``width`` neighbours."""
    n, have = len(x) - width + 1, 1
    while have * 2 <= width:
        x = of(x[:-have], x[have:])
        have *= 2
    return of(x[:n], x[width - have:width - have + n])


def anchors(buf: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and 48-bit hashes of the anchors. room: bytes to the end of the
    document at each position; windows that don't fit in it don't count."""
    if len(buf) < WIDTH:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    full = gram_hashes(buf)
    order = np.maximum(full >> np.uint64(32), np.uint64(1)).astype(np.uint32)     # 0 marks windows that don't fit
    low = _sliding(order, BEFORE + 1, np.minimum)
    low[room[:len(low)] < WIDTH] = 0
    pad = np.zeros(BEFORE, np.uint32)
    best = _sliding(np.concatenate([pad, low, pad]), BEFORE + 1, np.maximum)
    at = np.flatnonzero((best == order) & (order > 0))
    return at, full[at] & np.uint64((1 << _BITS) - 1)


def _pack(x: np.ndarray) -> bytes:
    return zlib.compress(x.tobytes(), 1)


def _unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zlib.decompress(b), kind)


class Chunk:
    """A chunk's documents in ascending (id, text) order, as one buffer."""

    def __init__(self, table: pa.Table):
        rows = sorted(zip(table["id"].to_pylist(), table["text"].to_pylist(), range(len(table))))
        raw = [t.encode("utf-8", "surrogatepass") for _, t, _ in rows]
        self.ids, self.order = np.array([i for i, _, _ in rows], np.int64), [n for _, _, n in rows]
        self.buf = np.frombuffer(b"".join(raw), np.uint8)
        self.ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
        self.starts = self.ends - np.array([len(r) for r in raw], np.int64)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions, hashes and document numbers, by slices of bounded size."""
        found, hashes = [], []
        for s in range(0, len(self.buf), _SLICE):
            e = min(len(self.buf), s + _SLICE + WIDTH - 1)
            first, last = np.searchsorted(self.ends, [s, e - 1], "right")
            bounds = np.minimum(self.ends[first:last + 1], e)
            lengths = np.diff(np.concatenate([[s], bounds]))
            room = np.repeat(bounds, lengths) - np.arange(s, e)
            at, h = anchors(self.buf[s:e], room)
            found.append(at + s)
            hashes.append(h)
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
        at, first = np.unique(np.concatenate(found), return_index=True)
        return at, np.concatenate(hashes)[first], np.searchsorted(self.ends, at, "right")


def _planes(x: np.ndarray) -> bytes:
    """The bytes of sorted numbers, the highest of all first: they compress well."""
    return x.astype(">u8").view(np.uint8).reshape(-1, 8).T[2:].tobytes()


def _unplanes(b: bytes) -> np.ndarray:
    six = np.frombuffer(b, np.uint8).reshape(6, -1)
    return np.concatenate([np.zeros((2, six.shape[1]), np.uint8), six]).T.copy().view(">u8").ravel().astype(np.uint64)


def announcer(buckets: int):
    """chunk -> (bucket, chunk, hashes, counts): its anchors' distinct hashes and how many have them, by ranges."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, hashes, _ = Chunk(table).anchors()
        hashes, counts = np.unique(hashes, return_counts=True)
        part = ((hashes >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(_BITS - 16)
        cut = np.flatnonzero(np.diff(part)) + 1
        pieces = [p for p in np.split(hashes, cut) if len(p)]
        numbers = [_pack(n.astype(np.int32)) for n in np.split(counts, cut) if len(n)]
        return pa.table({"bucket": pa.array([int((int(p[0]) >> 16) * buckets >> (_BITS - 16)) for p in pieces], pa.int64()),
                         "chunk": pa.array([key[0].as_py()] * len(pieces), pa.int64()),
                         "hashes": pa.array([_planes(p) for p in pieces], pa.binary()),
                         "counts": pa.array(numbers, pa.binary())})
    return run


def matcher(most: int):
    """bucket -> (chunk, hashes, hot): the hashes that other chunks announced
    too, and those of them that more than ``most`` anchors have."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = [_unplanes(b) for b in table["hashes"].to_pylist()]
        anchors_of = np.concatenate([_unpack(b, np.int32) for b in table["counts"].to_pylist()])
        values, inverse, counts = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
        shared = values[counts > 1]
        hot = values[(counts > 1) & (np.bincount(inverse, anchors_of) > most)]
        hits = [r[np.isin(r, shared, assume_unique=True)] for r in rows]
        keep = [i for i, h in enumerate(hits) if len(h)]
        return pa.table({"chunk": table["chunk"].take(pa.array(keep, pa.int64())), "hashes": pa.array([_planes(hits[i]) for i in keep], pa.binary()),
                         "hot": pa.array([_planes(hits[i][np.isin(hits[i], hot, assume_unique=True)]) for i in keep], pa.binary())})
    return run


def _contexts(chunk: Chunk, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The keys, one row of bytes each: right context, reversed left context, lengths."""
    right = np.minimum(chunk.ends[doc] - at, WIDTH)
    left = np.minimum(at - chunk.starts[doc], BEFORE)
    padded = np.concatenate([np.zeros(BEFORE, np.uint8), chunk.buf, np.zeros(WIDTH, np.uint8)])
    keys = np.empty((len(at), KEY), np.uint8)
    for j in range(WIDTH):
        keys[:, j] = np.where(j < right, padded[at + BEFORE + j], 0)
    for j in range(BEFORE):
        keys[:, WIDTH + j] = np.where(j < left, padded[at + BEFORE - 1 - j], 0)
    keys[:, -2], keys[:, -1] = right, left
    return keys


def offsets(right: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance from a window's start to its anchor."""
    return np.maximum(0, WIDTH - right.astype(np.int64)), np.minimum(BEFORE, left.astype(np.int64))


def _lcps(keys: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before."""
    out = np.zeros(len(keys), np.uint8)
    for i in range(1, len(keys), 1 << 16):
        same = keys[i:i + (1 << 16)] == keys[i - 1:i - 1 + min(1 << 16, len(keys) - i)]
        out[i:i + len(same)] = np.where(same.all(1), KEY, np.argmin(same, 1))
    return out


RUN_FIELDS = "kind int, bucket long, chunk long, a binary, b binary, c binary, d binary"


def hot_windows(chunk: Chunk, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Ascending starts of the windows that hold one of these anchors."""
    low, high = offsets(np.minimum(chunk.ends[doc] - at, WIDTH), np.minimum(at - chunk.starts[doc], BEFORE))
    marks = np.zeros(len(chunk.buf) + 1, np.int32)
    some = low <= high
    np.add.at(marks, (at - high)[some], 1)
    np.add.at(marks, (at - low + 1)[some], -1)
    return np.flatnonzero(np.cumsum(marks[:-1]) > 0)


def sorter(splitters: list[bytes], ranges: int):
    """(chunk, shared hashes) -> its front-coded sorted run by ranges of the
    grams (kind 0: prefixes, rests, ids, first number in the run), and what it needs
    to read the answers (kind 1: entry, position, offsets; -1 for the entry's smallest id).
    Of hot grams the windows' hashes and smallest ids by ranges of the hashes (kind 2),
    and where the windows start (kind 3)."""
    bounds = np.array(splitters or [b"\xff" * GRAM], f"S{GRAM}")

    def run(key: tuple[pa.Scalar, ...], table: pa.Table, told: pa.Table) -> pa.Table:
        chunk = Chunk(table)
        at, hashes, doc = chunk.anchors()
        order = np.argsort(hashes, kind="stable")           # positions ascend, hence ids within equal hashes
        h, i = hashes[order], chunk.ids[doc][order]
        own = np.unique(h[1:][(h[1:] == h[:-1]) & (i[1:] != i[:-1])])      # of two documents of this chunk
        known = np.concatenate([own, *map(_unplanes, told["hashes"].to_pylist())])
        keep = np.isin(hashes, known)
        hot = keep & np.isin(hashes, np.concatenate([np.empty(0, np.uint64), *map(_unplanes, told["hot"].to_pylist())]))
        keep &= ~hot
        hot_at, hot_doc = at[hot], doc[hot]
        at, doc = at[keep], doc[keep]
        out = {f: [] for f in ("kind", "bucket", "chunk", "a", "b", "c", "d")}

        def add(*row):
            for f, v in zip(out, row):
                out[f].append(v)

        number = key[0].as_py()
        if len(hot_at):
            starts = hot_windows(chunk, hot_at, hot_doc)
            add(3, -1, number, _pack(np.diff(starts, prepend=0).astype(np.int32)), None, None, None)
            windows, heads = np.unique(window_hashes(chunk.buf, starts), return_index=True)   # ids ascend: the first is the smallest
            least = chunk.ids[np.searchsorted(chunk.ends, starts[heads], "right")]
            part = ((windows >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
            cut = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
            for s, e in zip(cut[:-1], cut[1:]):
                add(2, int(part[s]), number, windows[s:e].tobytes(), _pack(least[s:e]), None, None)
        if len(at):
            keys = _contexts(chunk, at, doc)
            flat = np.ascontiguousarray(keys).view(f"S{KEY}").ravel()
            order = np.argsort(flat, kind="stable")          # positions ascend, hence ids within equal keys
            low, high = offsets(keys[:, -2], keys[:, -1])
            sorted_keys = keys[order]
            del flat, keys
            new = np.concatenate([[True], (sorted_keys[1:] != sorted_keys[:-1]).any(1)])
            entry = np.empty(len(at), np.int64)
            entry[order] = np.cumsum(new) - 1
            heads = order[new]
            least = chunk.ids[doc[heads]]
            first = chunk.ids[doc] == least[entry]
            add(1, -1, number, _pack(entry.astype(np.int32)), _pack(np.diff(at, prepend=0).astype(np.int32)), _pack(np.where(first, -1, low).astype(np.int8)), _pack(high.astype(np.int8)))
            run_keys = sorted_keys[new]
            del sorted_keys
            lcp = _lcps(run_keys)
            part = np.searchsorted(bounds, np.ascontiguousarray(run_keys[:, :GRAM]).view(f"S{GRAM}").ravel(), "right")
            cut = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
            for s, e in zip(cut[:-1], cut[1:]):
                piece = lcp[s:e].copy()
                piece[0] = 0
                rests = run_keys[s:e][np.arange(KEY) >= piece[:, None]]
                add(0, int(part[s]), number, piece.tobytes(), _pack(rests), _pack(least[s:e]), np.array([s], np.int64).tobytes())
        types = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
        return pa.table({f: pa.array(v, t) for (f, v), t in zip(out.items(), types)})
    return run


def _run(prefixes: bytes, rests: bytes) -> Iterator[tuple[bytes, int]]:
    """The keys of a front-coded run, each with the prefix it shares with the last."""
    last, at = b"", 0
    for lcp in prefixes:
        last = last[:lcp] + rests[at:at + KEY - lcp]
        at += KEY - lcp
        yield last, lcp


def merge(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[int, bytes, int]]:
    """(run, key, prefix shared with the key before), ascending.

    Every head knows the prefix it shares with the last winner. In a match the
    longer one wins; on a tie the bytes past it decide, and the loser learns
    the prefix it shares with the winner, which is what it needs when that
    winner has left."""
    size = 1
    while size < len(runs):
        size *= 2
    heads: list[bytes | None] = [None] * size
    shares = [0] * size

    def pull(r: int) -> None:
        heads[r], shares[r] = next(runs[r], (None, -1)) if r < len(runs) else (None, -1)

    def loser(a: int, b: int) -> tuple[int, int]:
        """The winner and the loser of two runs."""
        x, y = shares[a], shares[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        p, q = heads[a][x:], heads[b][x:]
        if p == q:
            shares[b] = KEY
            return a, b
        differ = int.from_bytes(p, "big") ^ int.from_bytes(q, "big")
        common = KEY - (differ.bit_length() + 7) // 8
        if p < q:
            shares[b] = common
            return a, b
        shares[a] = common
        return b, a

    for r in range(size):
        pull(r)
    losers = [0] * size
    level = list(range(size))
    node = size
    while len(level) > 1:
        node //= 2
        up = []
        for i in range(0, len(level), 2):
            w, l = loser(level[i], level[i + 1])
            losers[node + i // 2] = l
            up.append(w)
        level = up
    winner = level[0]
    while heads[winner] is not None:
        yield winner, heads[winner], shares[winner]
        pull(winner)
        at, w = (winner + size) // 2, winner
        while at:
            w, losers[at] = loser(w, losers[at])
            at //= 2
        winner = w


def repeats(keys: np.ndarray, ids: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest offset of the windows of each context that a context
    of a smaller id holds too; -1 where there are none."""
    n = len(keys)
    low, high = np.full(n, -1, np.int8), np.full(n, -1, np.int8)
    first, last = offsets(keys[:, -2], keys[:, -1])
    right = np.zeros((BEFORE + 1, n), np.uint64)          # hash of the first WIDTH - o bytes, by o
    h = group.astype(np.uint64) * _B
    for j in range(WIDTH):
        h = h * _A + keys[:, j] + np.uint64(1)
        if WIDTH - 1 - j <= BEFORE:
            right[WIDTH - 1 - j] = h
    h = np.zeros(n, np.uint64)
    for o in range(BEFORE + 1):
        if o:
            h = h * _A + keys[:, WIDTH + o - 1] + np.uint64(1)
        window = _mix(_mix(right[o]) + h * _B)
        fits = np.flatnonzero((first <= o) & (o <= last))
        if not len(fits):
            continue
        order = fits[np.argsort(window[fits], kind="stable")]
        v = window[order]
        starts = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        least = np.repeat(np.minimum.reduceat(ids[order], starts), np.diff(np.append(starts, len(order))))
        hit = order[least < ids[order]]
        high[hit] = o
        low[hit] = np.where(low[hit] < 0, o, low[hit])
    return low, high


def merger(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """bucket of runs -> (chunk, entries, least and greatest offsets) of the
    entries whose windows a smaller id holds."""
    a, b, c, d, chunks = (table[f].to_pylist() for f in ("a", "b", "c", "d", "chunk"))
    ids = [_unpack(x, np.int64) for x in c]
    entries = [np.arange(len(i), dtype=np.int32) + int(np.frombuffer(x, np.int64)[0]) for i, x in zip(ids, d)]
    begin = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    total = int(begin[-1])
    keys, came, lcp, nth = bytearray(), np.empty(total, np.int64), np.empty(total, np.uint8), [0] * len(a)
    for i, (r, k, share) in enumerate(merge([_run(x, zlib.decompress(y)) for x, y in zip(a, b)])):
        keys += k
        came[i], lcp[i] = begin[r] + nth[r], share
        nth[r] += 1
    matrix = np.frombuffer(bytes(keys), np.uint8).reshape(-1, KEY)
    new = lcp < GRAM
    new[:1] = True
    group = np.cumsum(new)
    alone = new & np.append(new[1:], True)
    some = np.flatnonzero(~alone)
    low, high = repeats(matrix[some], np.concatenate(ids)[came[some]], group[some])
    hit = np.flatnonzero(high >= 0)
    source = came[some][hit]
    run = np.searchsorted(begin, source, "right") - 1
    out = {"chunk": [], "a": [], "c": [], "d": []}
    number = np.concatenate(entries)[source]
    for r in np.unique(run):
        own = np.flatnonzero(run == r)
        out["chunk"].append(chunks[r])
        out["a"].append(number[own].tobytes())
        out["c"].append(low[hit[own]].tobytes())
        out["d"].append(high[hit[own]].tobytes())
    return pa.table({"chunk": pa.array(out["chunk"], pa.int64()), **{f: pa.array(out[f], pa.binary()) for f in "acd"}})


def window_matcher(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """bucket of windows' hashes -> (chunk, hashes, ids) of those that a smaller id of another chunk has."""
    hashes, ids = [np.frombuffer(x, np.uint64) for x in table["a"].to_pylist()], [_unpack(x, np.int64) for x in table["b"].to_pylist()]
    values, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    least = np.full(len(values), np.iinfo(np.int64).max)
    every = np.concatenate(ids)
    np.minimum.at(least, inverse, every)
    out, at = {"chunk": [], "a": [], "c": []}, 0
    for chunk, h, i in zip(table["chunk"].to_pylist(), hashes, ids):
        low = least[inverse[at:at + len(h)]]
        at += len(h)
        hit = low < i
        if hit.any():
            out["chunk"].append(chunk)
            out["a"].append(h[hit].tobytes())
            out["c"].append(_pack(low[hit]))
    return pa.table({"chunk": pa.array(out["chunk"], pa.int64()), "a": pa.array(out["a"], pa.binary()), "c": pa.array(out["c"], pa.binary()),
                     "d": pa.array([None] * len(out["a"]), pa.binary())})


def whole_characters(buf: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """``gone`` without the bytes of UTF-8 characters that are not gone as a whole."""
    if not len(buf):
        return gone
    starts = np.flatnonzero((buf & 0xC0) != 0x80)
    return np.repeat(np.logical_and.reduceat(gone, starts), np.diff(np.append(starts, len(buf))))


def remove(table: pa.Table, told: pa.Table, characters: bool) -> pa.Table:
    chunk = Chunk(table)
    cover = np.zeros(len(chunk.buf) + 1, np.int32)
    kinds = told["kind"].to_pylist()
    a, b, c, d = (told[f].to_pylist() for f in "abcd")
    for i in (i for i, k in enumerate(kinds) if k == 1):
        entry, at = _unpack(a[i], np.int32), np.cumsum(_unpack(b[i], np.int32), dtype=np.int64)
        low, high = _unpack(c[i], np.int8).astype(np.int64), _unpack(d[i], np.int8).astype(np.int64)
        answer_low, answer_high = (np.full(entry.max() + 1, -1, np.int64) for _ in range(2))
        for j in (j for j, k in enumerate(kinds) if k == 0):
            which = np.frombuffer(a[j], np.int32)
            answer_low[which], answer_high[which] = np.frombuffer(c[j], np.int8), np.frombuffer(d[j], np.int8)
        own = low < 0
        high = np.where(own, answer_high[entry], high)
        low = np.where(own, answer_low[entry], low)
        hit = high >= 0
        np.add.at(cover, at[hit] - high[hit], 1)
        np.add.at(cover, at[hit] - low[hit] + WIDTH, -1)
    for i in (i for i, k in enumerate(kinds) if k == 3):
        starts = np.cumsum(_unpack(a[i], np.int32), dtype=np.int64)
        own = chunk.ids[np.searchsorted(chunk.ends, starts, "right")]
        windows, heads, inverse = np.unique(window_hashes(chunk.buf, starts), return_index=True, return_inverse=True)
        least = own[heads]
        for j in (j for j, k in enumerate(kinds) if k == 2):
            least[np.searchsorted(windows, np.frombuffer(a[j], np.uint64))] = _unpack(c[j], np.int64)
        hit = starts[least[inverse] < own]
        cover[:-1][hit] += 1
        np.add.at(cover, hit + WIDTH, -1)
    gone = np.cumsum(cover[:-1]) > 0
    removed, spans, kept = [], [], []
    for s, e in zip(chunk.starts, chunk.ends):
        g = whole_characters(chunk.buf[s:e], gone[s:e]) if characters else gone[s:e]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], g.view(np.int8), [0]]))).reshape(-1, 2)
        removed.append(int(g.sum()))
        spans.append([{"start": int(x), "end": int(y)} for x, y in edges])
        kept.append(chunk.buf[s:e][~g].tobytes())
    return pa.table({"id": pa.array(chunk.ids, pa.int64()), "n_bytes": pa.array(chunk.ends - chunk.starts, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                     "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "kept": pa.array(kept, pa.binary()),
                     **{c: table[c].take(pa.array(chunk.order, pa.int64())) for c in table.column_names if c not in ("chunk", "id", "text")}})


def remover(characters: bool):
    """(chunk, notes and answers) -> every document's removed spans and kept bytes."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table, told: pa.Table) -> pa.Table:
        return remove(table, told, characters)
    return run
