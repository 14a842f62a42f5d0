"""Lockstep alignment of two tokenizations of the same bytes (task side).

The tokens of a batch lie one document after the other, with the byte offset at
which each ends. One state vector holds a pointer into A's tokens and one into
B's for every lane, which is a document or, of a long one, about ``LANE`` tokens.
Every step compares all lanes' two ends at once: where they are equal
the tokens are linked and the bytes cut there, and the pointer (or both) whose
token ends first moves on. Lanes that are done leave the vector.

A long document is cut into lanes at offsets where tokens of both end.
"""

from __future__ import annotations

import json
import os
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .bpe_model import PATTERN, byte_letters

#: Tokens of a lane, tokens in which an end of both is looked for, bytes of texts held at a time.
LANE, WINDOW, HELD = 1024, 64, 1_000_000
#: Links that are looked up at a time.
HELD_LINKS = 1 << 18
#: The B id's bits of a linked pair.
B_BITS = 32


class Tokenizers:
    """A byte-level BPE file of the tokenizers library (A) and a model of the
    sentencepiece library (B)."""

    def __init__(self, a_content: str, b_content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        spec = json.loads(a_content)
        letters = {c: b for b, c in byte_letters().items()}
        vocab = spec["model"]["vocab"]
        self.a_bytes = {i: bytes(letters[c] for c in t) if set(t) <= letters.keys() else t.encode() for t, i in vocab.items()}
        self.a_ids = ranked(spec, self.a_bytes)
        if self.a_ids is None:
            from tokenizers import Tokenizer
            model = Tokenizer.from_str(a_content)
            model.no_truncation()
            model.no_padding()
            model.encode_special_tokens = True
            self.a_ids = lambda text: np.array(model.encode(text, add_special_tokens=False).ids, np.int64)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_content)
        self.b_bytes = {i: _piece(self.b, i) for i in range(self.b.get_piece_size())}
        if min(map(len, self.a_bytes.values())) == 0 or min(map(len, self.b_bytes.values())) == 0:
            raise ValueError("a token has no bytes")
        self.a_length = _lengths(self.a_bytes)
        self.b_length = _lengths(self.b_bytes)
        self.a_text, self.b_text = (_decimals(len(x)) for x in (self.a_length, self.b_length))

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of space+text of A, of text of B; none for an empty text, and
        where the tokens' bytes are not space+text."""
        none = np.empty(0, np.int64)
        if not text:
            return none, none
        raw = (" " + text).encode()
        a, b = self.a_ids(" " + text), self.b.encode(text)
        if self.a_length[a].sum() != len(raw) or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return none, none
        return a, np.array(b, np.int64)


def ranked(spec: dict, bytes_of: dict[int, bytes]):
    """text -> ids by the tiktoken library, which is several times as fast, if
    the file is one whose merges follow its ids (so the ids are the same); else None."""
    import tiktoken
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    made = [model["vocab"].get(x + y) for x, y in merges]
    added = {t["id"] for t in spec.get("added_tokens", [])}
    basic = {i for i, raw in bytes_of.items() if len(raw) == 1 and i not in added}
    plain = (split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True) and not spec.get("normalizer")
             and not model.get("ignore_merges") and not model.get("dropout") and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")))
    if not plain or None in made or any(x >= y for x, y in zip(made, made[1:])) or len(basic) != 256 or (basic and made and max(basic) >= made[0]):
        return None
    if basic | set(made) != set(bytes_of) - added:
        return None
    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={bytes_of[i]: i for i in basic | set(made)}, special_tokens={})
    return lambda text: encoding.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype(np.int64)


def _piece(model, i: int) -> bytes:
    piece = model.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()


def _lengths(of: dict[int, bytes]) -> np.ndarray:
    out = np.zeros(max(of) + 1, np.int64)
    for i, raw in of.items():
        out[i] = len(raw)
    return out


def _decimals(n: int) -> np.ndarray:
    """The ids as decimal digits in columns of one width, with a column for the
    separator behind them; unused bytes are 0."""
    width = len(str(n)) + 1
    out = np.zeros((n, width), np.uint8)
    for i in range(n):
        digits = str(i).encode()
        out[i, :len(digits)] = list(digits)
    return out


def lockstep(a_end: np.ndarray, b_end: np.ndarray, lanes: np.ndarray) -> np.ndarray:
    """For each token of A the token of B that ends with it, or -1.

    ``a_end``, ``b_end``: byte offsets at which the tokens end. ``lanes``: rows
    of the first token of A, the first of B, and the last of A plus one; a
    lane's first and last tokens begin and end together.
    """
    partner = np.full(len(a_end), -1, np.int64)
    a, b, stop = lanes[lanes[:, 0] < lanes[:, 2]].T.copy()
    while len(a):
        ends_a, ends_b = a_end[a], b_end[b]
        links = np.flatnonzero(ends_a == ends_b)
        partner[a[links]] = b[links]
        a += ends_a <= ends_b
        b += ends_b <= ends_a
        live = a < stop
        if not live.all():
            a, b, stop = a[live], b[live], stop[live]
    return partner


def lanes_of(a_end: np.ndarray, b_end: np.ndarray) -> list[tuple[int, int, int]]:
    """A document's lanes: about every ``LANE`` tokens of A one begins, where
    the next few tokens hold an end of both."""
    out, a, b = [], 0, 0
    for at in range(LANE, len(a_end) - WINDOW, LANE):
        near = a_end[at:at + WINDOW]
        place = np.searchsorted(b_end, near)
        both = np.flatnonzero(b_end[np.minimum(place, len(b_end) - 1)] == near)
        if len(both):
            out.append((a, b, at + int(both[0]) + 1))
            a, b = at + int(both[0]) + 1, int(place[both[0]]) + 1
    return [*out, (a, b, len(a_end))]


def align(tokenizers: Tokenizers, texts: list[str | None]) -> list[tuple[int, int, int, bytes, np.ndarray]]:
    """Of every text: A's and B's number of tokens, of links, the groups as
    ``a1,a2|b1;a3|b2,b3``, and the linked ids (A's shifted by ``B_BITS``, or B's)."""
    rows = [tokenizers.encode(t) for t in texts]
    a, b = (np.concatenate([r[i] for r in rows]) for i in (0, 1))
    a_end, b_end = np.cumsum(tokenizers.a_length[a]), np.cumsum(tokenizers.b_length[b])
    a_first, b_first = (np.cumsum([0, *(len(r[i]) for r in rows)]) for i in (0, 1))
    lanes = [(x + a_first[d], y + b_first[d], z + a_first[d]) for d, r in enumerate(rows) if len(r[0])
             for x, y, z in lanes_of(a_end[a_first[d]:a_first[d + 1]], b_end[b_first[d]:b_first[d + 1]])]
    partner = lockstep(a_end, b_end, np.array(lanes, np.int64).reshape(-1, 3))
    linked = np.flatnonzero(partner >= 0)
    text, start = _groups(tokenizers, a, b, linked, partner[linked])
    pairs = (a[linked] << B_BITS) | b[partner[linked]]
    cuts = np.searchsorted(linked, a_first)
    out = []
    for d in range(len(texts)):
        groups = text[start * (a_first[d] + b_first[d]):start * (a_first[d + 1] + b_first[d + 1])].translate(None, b"\0")[:-1]
        out.append((len(rows[d][0]), len(rows[d][1]), int(cuts[d + 1] - cuts[d]), groups, pairs[cuts[d]:cuts[d + 1]]))
    return out


def _groups(tokenizers: Tokenizers, a, b, a_cut, b_cut) -> tuple[bytes, int]:
    """All tokens' digits and separators in order of groups, and a token's width."""
    width = max(tokenizers.a_text.shape[1], tokenizers.b_text.shape[1])
    out = np.zeros((len(a) + len(b), width), np.uint8)
    # a token stands behind the other's tokens of the groups before it (A's own group too)
    group_a = np.searchsorted(a_cut, np.arange(len(a)))
    group_b = np.searchsorted(b_cut, np.arange(len(b)))
    for table, ids, at, cut, sign in (
            (tokenizers.a_text, a, np.arange(len(a)) + np.concatenate([[0], b_cut + 1])[group_a], a_cut, b"|"),
            (tokenizers.b_text, b, np.arange(len(b)) + (a_cut + 1)[group_b] if len(b) else np.empty(0, np.int64), b_cut, b";")):
        rows = np.zeros((len(ids), width), np.uint8)
        rows[:, :table.shape[1]] = table[ids]
        rows[:, -1] = ord(",")
        rows[cut, -1] = ord(sign)
        out[at] = rows
    return out.tobytes(), width


def slices(texts: pa.Array) -> Iterator[slice]:
    """Runs of texts of bounded length together, of one text at least."""
    begin = size = 0
    for i, n in enumerate(pc.binary_length(texts).fill_null(0).to_pylist()):
        size += n
        if size >= HELD or i + 1 == len(texts):
            yield slice(begin, i + 1)
            begin, size = i + 1, 0


def aligner(a_content, b_content, per_process):
    """(id, text) -> (id, n_a, n_b, n_links, groups, pairs); the files are broadcast."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = per_process(f"aligned_{hash(a_content.value)}_{hash(b_content.value)}", lambda: Tokenizers(a_content.value, b_content.value))
        for batch in batches:
            for part in slices(batch.column(1)):
                n_a, n_b, n, groups, pairs = zip(*align(tokenizers, batch.column(1)[part].to_pylist()))
                ends = np.cumsum([0, *map(len, pairs)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part], pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()), pa.array(n, pa.int64()),
                     pa.array([g.decode() for g in groups], pa.string()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(pairs), pa.int64()))],
                    ["id", "n_a", "n_b", "n_links", "groups", "pairs"])
    return run


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a bounded number of links together, of one row at least."""
    for batch in batches:
        ends = np.cumsum(batch.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < batch.num_rows:
            before = int(ends[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + HELD_LINKS, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


def scorer(pairs, counts, best):
    """(key, pairs) -> (key, hot_sum, hot_best): sums over the links among the
    broadcast pairs, which ascend."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, top = pairs.value, counts.value, best.value
        for batch in parts(batches):
            row, found, values = _lookup(batch.column(1), known)
            at = found[values]
            sums, tops = (np.zeros(batch.num_rows, np.int64) for _ in range(2))
            np.add.at(sums, row[values], n[at])
            np.add.at(tops, row[values], top[at].astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums), pa.array(tops)], ["key", "hot_sum", "hot_best"])
    return run


def others(pairs):
    """(key, pairs) -> (key, pair, times): the links that are not among the broadcast pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pairs.value
        for batch in parts(batches):
            row, _, values = _lookup(batch.column(1), known)
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)[~values]
            rows = row[~values]
            order = np.lexsort((flat, rows))
            flat, rows = flat[order], rows[order]
            new = np.flatnonzero(np.concatenate([[True], (flat[1:] != flat[:-1]) | (rows[1:] != rows[:-1])])) if len(flat) else np.empty(0, np.int64)
            times = np.diff(np.append(new, len(flat)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows[new])), pa.array(flat[new], pa.int64()), pa.array(times, pa.int64())], ["key", "pair", "times"])
    return run


def _lookup(column: pa.ListArray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every link: its row, its place among ``known``, and whether it is there."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(column)), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    place = np.minimum(np.searchsorted(known, flat), max(0, len(known) - 1))
    return row, place, known[place] == flat if len(known) else np.zeros(len(flat), bool)
