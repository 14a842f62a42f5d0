"""Byte-pair encoding by per-prefix dynamic programming (task side).

For every prefix of a word the last token of its encoding is unique. It is the
one of the vocabulary's tokens that end the prefix which is compatible with the
last token of the prefix before it: side by side, the two stay as they are.
The automaton of all tokens gives those that end at each byte; following the
stored last tokens back from the word's end gives its ids.

Two tokens are compatible if no merge ever joins what lies at their border
while they are built. The right edge of the left one and the left edge of the
right one are chains of ever smaller parts; a part lives until the merge that
makes its parent. A merge of a left part with a right one happens if it ranks
before both of these (the leftmost of equal merges goes first).
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Fixed value: how byte-level BPE splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_NEVER = 1 << 62
_SPLIT = regex.compile(PATTERN).findall
#: A space beside other white space (of either kind), or white space at an end.
_ODD = re.compile(r" [\s\x1c-\x1f]|[\s\x1c-\x1f] |\A[\s\x1c-\x1f]|[\s\x1c-\x1f]\Z").search
_CACHED, _PAIRS, _BATCH_CHARS = 400_000, 1_000_000, 1_000_000
_REMEMBERED, _SLICE_BYTES = 1_000_000, 8_000_000


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself where printable, else the
    next one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Vocabulary:
    """A byte-level BPE vocabulary file: merges, token bytes, added tokens."""

    def __init__(self, content: str):
        spec = json.loads(content)
        letters = {c: b for b, c in byte_letters().items()}
        ids = spec["model"]["vocab"]
        self.bytes_of = {i: bytes(letters[c] for c in t) for t, i in ids.items()}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        self._edges: dict[tuple[int, bool], list[tuple[int, int]]] = {}
        self._compatible: dict[int, bool] = {}
        self._words: dict[str, bytes] = {}
        made = set()
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            pair = ids[a], ids[b]
            self.rank[pair] = r
            if (whole := ids[a + b]) not in self.parts and self._meet(*pair, r):
                self.parts[whole] = (*pair, r)
                made.add(whole)
        self._has_added = re.compile("|".join(map(re.escape, self.added))).search if self.added else lambda text: None
        self.automaton = ahocorasick.Automaton()
        for t, i in ids.items():
            raw = self.bytes_of[i]
            if t not in self.added and (len(raw) == 1 or i in made):
                self.automaton.add_word(raw.decode("latin-1"), (i, len(raw)))
        self.automaton.make_automaton()

    def forget(self) -> None:
        """Without what was remembered of texts."""
        self._words.clear()
        self._compatible.clear()
        self._edges.clear()

    def _edge(self, token: int, right: bool) -> list[tuple[int, int]]:
        """The token and its parts along one edge, each with the rank that ends it."""
        key = token, right
        if key not in self._edges:
            out, end = [], _NEVER
            while True:
                out.append((token, end))
                if token not in self.parts:
                    break
                left, other, end = self.parts[token]
                token = other if right else left
            self._edges[key] = out
        return self._edges[key]

    def _meet(self, a: int, b: int, limit: int = _NEVER) -> bool:
        """No merge before rank ``limit`` joins parts of a and b at their border."""
        rank = self.rank
        for x, x_end in self._edge(a, True):
            for y, y_end in self._edge(b, False):
                r = rank.get((x, y))
                if r is not None and r < limit and r < x_end and r <= y_end:
                    return False
        return True

    def encode_word(self, raw: bytes) -> list[int]:
        """The ids of one word, a piece that merges never leave."""
        n = len(raw)
        last, size, known = [-1] * (n + 1), [0] * (n + 1), self._compatible
        if len(known) > _PAIRS:
            known.clear()
        for end, (token, length) in self.automaton.iter(raw.decode("latin-1")):
            end += 1
            if last[end] >= 0:
                continue
            if end > length:
                before = last[end - length]
                if before < 0:
                    continue
                key = before << 32 | token
                fits = known.get(key)
                if fits is None:
                    fits = known[key] = self._meet(before, token)
                if not fits:
                    continue
            last[end], size[end] = token, length
        out = []
        while n:
            if last[n] < 0:
                raise ValueError("the vocabulary lacks a byte")
            out.append(last[n])
            n -= size[n]
        return out[::-1]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), np.int32).tolist()

    def encode_packed(self, text: str) -> bytes:
        """The ids as 32-bit numbers. Words are remembered as bytes, which the
        garbage collector does not visit."""
        out: list[bytes] = []
        parts = [text]
        if self._has_added(text):
            parts = regex.split("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")", text)
        words = self._words
        if len(words) > _CACHED:
            words.clear()
        for part in parts:
            if part in self.added:
                out.append(np.array([self.added[part]], np.int32).tobytes())
                continue
            for word in _SPLIT(part):
                ids = words.get(word)
                if ids is None:
                    ids = words[word] = array("i", self.encode_word(word.encode("utf-8", "surrogatepass"))).tobytes()
                out.append(ids)
        return b"".join(out)


class ChunkEncoder:
    """Encodes whole texts by the chunks between single spaces, remembered.

    No piece of the split pattern reaches over a space that has a visible
    character on either side, so the chunks' ids concatenate to the text's.
    New chunks of a batch are encoded together.
    """

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]]):
        """``encode_many``: texts -> their ids as 32-bit numbers."""
        self.encode_many, self.known = encode_many, {}

    @staticmethod
    def chunks(text: str) -> list[str]:
        """The chunks, all but the first with their space in front."""
        parts = text.split(" ")
        if "" in parts or _ODD(text):
            parts = regex.split(r"(?<=[^\s\x1c-\x1f]) (?=[^\s\x1c-\x1f])", text)
        return parts

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        known = self.known
        split = [self.chunks(t) if t else [] for t in texts]
        new = {c for parts in split for c in parts[1:] if c not in known}
        if new:
            if len(known) > _CACHED:
                known.clear()
                new = {c for parts in split for c in parts[1:]}
            listed = list(new)
            for i in range(0, len(listed), 4096):
                some = listed[i:i + 4096]
                known.update(zip(some, self.encode_many([" " + c for c in some])))
        first = self.encode_many([parts[0] for parts in split if parts])
        firsts = iter(first)
        return [np.frombuffer(b"".join([next(firsts), *map(known.__getitem__, parts[1:])]), np.int32) if parts else np.empty(0, np.int32) for parts in split]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


def ids_array(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int64)
    values = pa.array(np.concatenate(rows) if rows else np.empty(0, np.int32), pa.int32())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _slices(texts: list[str | None]) -> Iterator[slice]:
    """Runs of texts of bounded length together, of one text at least."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= _BATCH_CHARS or i + 1 == len(texts):
            yield slice(begin, i + 1)
            begin, size = i + 1, 0


def codec(content, per_process):
    """(id, text) -> (id, ids, decoded); ``content``: the vocabulary file, broadcast.
    What a task has remembered goes with it; the vocabulary stays in the process."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def build():
            vocabulary = Vocabulary(content.value)
            return vocabulary, [vocabulary.bytes_of.get(i, b"") for i in range(max(vocabulary.bytes_of) + 1)]

        vocabulary, table = per_process(f"bpe_{hash(content.value)}", build)
        encoder = ChunkEncoder(lambda chunks: list(map(vocabulary.encode_packed, chunks)))
        try:
            for batch in batches:
                texts = batch.column(1).to_pylist()
                for part in _slices(texts):
                    rows = encoder.encode_all([t or "" for t in texts[part]])
                    decoded = [b"".join(map(table.__getitem__, ids.tolist())).decode("utf-8", "replace") for ids in rows]
                    yield pa.RecordBatch.from_arrays([batch.column(0)[part], ids_array(rows), pa.array(decoded, pa.string())], ["id", "ids", "decoded"])
        finally:
            vocabulary.forget()
    return run


class Remembered:
    """Distinct strings and their ids in flat arrays, at most ``most`` of them
    between two calls: the half looked up last stays."""

    def __init__(self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], most: int = _REMEMBERED):
        """``encode``: strings -> all their ids, and how many each has."""
        self.encode, self.most, self.calls = encode, most, 0
        self.strings, self.ids = pa.array([], pa.string()), np.empty(0, np.int32)
        self.length, self.seen = np.empty(0, np.int64), np.empty(0, np.int64)

    def look_up(self, distinct: pa.Array) -> np.ndarray:
        """Where each of the distinct strings stands, new ones included."""
        if len(self.strings) + len(distinct) > self.most and len(self.strings):
            self._forget()
        self.calls += 1
        found = pc.index_in(distinct, value_set=self.strings)
        new = distinct.filter(found.is_null())
        at = found.fill_null(-1).to_numpy().astype(np.int64)
        at[at < 0] = len(self.strings) + np.arange(len(new))
        if len(new):
            ids, length = self.encode(new)
            self.strings = pa.concat_arrays([self.strings, new])
            self.ids, self.length = np.concatenate([self.ids, ids]), np.concatenate([self.length, length])
            self.seen = np.concatenate([self.seen, np.zeros(len(new), np.int64)])
        self.seen[at] = self.calls
        return at

    def _forget(self) -> None:
        keep = np.sort(np.argsort(self.seen, kind="stable")[-(self.most // 2):])
        self.ids = gather(self.ids, self.length, keep)
        self.strings, self.length, self.seen = self.strings.take(pa.array(keep)), self.length[keep], self.seen[keep]


def gather(ids: np.ndarray, length: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The ids of entries, one after another; ``ids`` holds those of all entries."""
    start, size = (np.cumsum(length) - length)[which], length[which]
    ends = np.cumsum(size)
    return ids[np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


def _mask(strings: pa.Array, pattern: str) -> np.ndarray:
    return pc.match_substring_regex(strings, pattern).to_numpy(zero_copy_only=False).astype(bool)


def _joined(strings: pa.Array) -> str:
    _, offsets, data = strings.buffers()
    ends = np.frombuffer(offsets, np.int32)[[strings.offset, strings.offset + len(strings)]]
    return bytes(memoryview(data)[ends[0]:ends[1]]).decode()


#: Kinds of texts for the library: a space and a visible character first, no white space, any other.
SPACED, WORD, OTHER = range(3)


class ColumnEncoder:
    """Encodes columns of texts by the chunks between single spaces, as
    ``ChunkEncoder`` does, in Arrow arrays. A new chunk of visible ASCII, Latin
    letters and single line ends inside is cut into its pieces by the split
    pattern, and new pieces are encoded together; any other chunk is encoded as
    it is."""

    _IN_WHITE = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
    _WHITE = f"[{_IN_WHITE}]"
    ODD = f" {_WHITE}|{_WHITE} |\\A{_WHITE}|{_WHITE}\\z"
    SPACED, WORD = f"\\A [^{_IN_WHITE}]", f"\\A[^{_IN_WHITE}]+\\z"
    _LETTERS = r"A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{17f}"
    PLAIN = f"\\A[!-~{_LETTERS}]+(\n[!-~{_LETTERS}]+)*\\z"
    PIECES = f"('s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\\s{_LETTERS}0-9]+|\n)"

    def __init__(self, encode_many: Callable[[pa.Array, int], tuple[np.ndarray, np.ndarray]], added: list[str], most: int = _REMEMBERED):
        """``encode_many``: texts of a kind -> all their ids, and how many each has; ``added``: strings that the split pattern does not part."""
        self.encode_many, self.added = encode_many, added
        self.chunks, self.pieces = Remembered(self._chunks, most), Remembered(self._encoded, most)

    def _encoded(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Strings of a space and a visible character are encoded together, and those without white space."""
        kind = np.where(_mask(strings, self.SPACED), SPACED, np.where(_mask(strings, self.WORD), WORD, OTHER))
        order = np.argsort(kind, kind="stable")
        groups = [(k, np.flatnonzero(kind == k)) for k in (SPACED, WORD, OTHER)]
        found = [self.encode_many(strings.take(pa.array(rows[at:at + 4096])), k) for k, rows in groups for at in range(0, len(rows), 4096)]
        if not found:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        ids, length = (np.concatenate(part) for part in zip(*found))
        back = np.argsort(order)
        return gather(ids, length, back), length[back]

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        whole = ~_mask(chunks, self.PLAIN)
        for t in self.added:
            whole |= pc.match_substring(chunks, t).to_numpy(zero_copy_only=False)
        spaced = pc.binary_join_element_wise("", chunks, " ")
        kept, cut = np.flatnonzero(whole), np.flatnonzero(~whole)
        # a character that none has, behind each piece but the last, parts them
        lists = pc.split_pattern(pc.utf8_rtrim(pc.replace_substring_regex(spaced.take(pa.array(cut)), self.PIECES, "\\1\x01"), "\x01"), "\x01")
        coded = lists.flatten().dictionary_encode()
        at = self.pieces.look_up(coded.dictionary)[coded.indices.to_numpy()]
        length = np.zeros(len(chunks), np.int64)
        ends = np.append(0, np.cumsum(self.pieces.length[at]))[lists.offsets.to_numpy()]
        length[cut] = np.diff(ends)
        others, length[kept] = self._encoded(spaced.take(pa.array(kept)))
        both = np.concatenate([gather(self.pieces.ids, self.pieces.length, at), others])
        order = np.argsort(np.concatenate([cut, kept]), kind="stable")
        return gather(both, np.concatenate([length[cut], length[kept]]), order), length

    def _lists(self, texts: pa.Array) -> pa.Array:
        """The chunks of texts, without their spaces."""
        lists = pc.split_pattern(texts, " ")
        at = np.flatnonzero(_mask(texts, self.ODD))
        if not len(at):
            return lists
        split = pa.array([ChunkEncoder.chunks(t) for t in texts.take(pa.array(at)).to_pylist()], lists.type)
        place = np.arange(len(texts))
        place[at] = len(texts) + np.arange(len(at))
        return pa.concat_arrays([lists, split]).take(pa.array(place))

    def encode(self, texts: pa.Array, end_id: int) -> tuple[pa.Array, np.ndarray]:
        """Texts without nulls -> rows of their ids and an end id, as little-endian 32-bit numbers, and all these ids."""
        lists = self._lists(texts)
        flat, offsets, n = lists.flatten(), lists.offsets.to_numpy().astype(np.int64), len(texts)
        offsets = offsets - offsets[0]
        is_first = np.zeros(len(flat), bool)
        is_first[offsets[:-1]] = True
        coded = flat.filter(pa.array(~is_first)).dictionary_encode()
        at = self.chunks.look_up(coded.dictionary)[coded.indices.to_numpy()]
        firsts, first_length = self._encoded(flat.take(pa.array(offsets[:-1])))
        known = len(self.chunks.length)
        ids = np.concatenate([self.chunks.ids, firsts, np.array([end_id], np.int32)])
        length = np.concatenate([self.chunks.length, first_length, [1]]).astype(np.int64)
        which = np.full(len(flat) + n, known + n)                # an end behind each text's chunks
        where = np.arange(len(flat)) + np.repeat(np.arange(n), np.diff(offsets))
        which[where[~is_first]], which[where[is_first]] = at, known + np.arange(n)
        out = gather(ids, length, which).astype("<i4")
        ends = np.append(0, np.cumsum(length[which])[offsets[1:] + np.arange(n)]) * 4
        return pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out)]), out


def library_ids(model, lengths: np.ndarray):
    """Texts of a kind -> all their ids by the tokenizers library, and how many
    each has. Texts that begin with a space and a visible character are encoded
    as one, and parted by the number of bytes that their tokens stand for; so
    are texts without white space, with a line end behind each that is left out."""
    def encode_many(texts: pa.Array, kind: int) -> tuple[np.ndarray, np.ndarray]:
        if kind == OTHER:
            rows = [np.array(e.ids, np.int32) for e in model.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.concatenate(rows), np.array([len(r) for r in rows], np.int64)
        if kind == WORD:
            texts = pc.binary_join_element_wise(texts, "", "\n")
        ids = np.array(model.encode_batch_fast([_joined(texts)], add_special_tokens=False)[0].ids, np.int32)
        last = np.searchsorted(np.cumsum(lengths[ids]), np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64)), "left")
        length = np.diff(last, prepend=-1)
        return (np.delete(ids, last), length - 1) if kind == WORD else (ids, length)
    return encode_many


def library_encoder(content, end_id: int, per_process, pack_counts: Callable[[np.ndarray], bytes]):
    """(id, text) -> (id, ids, counts): the tokenizers library's ids and an end
    id, as little-endian 32-bit numbers; with the last row of a batch, how often
    each id is in the batch, as ``pack_counts`` has it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def build():
            import os
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            model = Tokenizer.from_str(content.value)
            model.no_truncation()
            model.no_padding()
            spec = json.loads(content.value)
            lengths = np.zeros(model.get_vocab_size(), np.int64)
            for token, i in spec["model"]["vocab"].items():
                lengths[i] = len(token)                       # a letter of a token stands for a byte
            added = [t["content"] for t in spec.get("added_tokens", [])]
            for t in spec.get("added_tokens", []):
                lengths[t["id"]] = len(t["content"].encode())
            return ColumnEncoder(library_ids(model, lengths), added)

        encoder = per_process(f"library_{hash(content.value)}", build)
        for batch in batches:
            texts = batch.column(1).cast(pa.string()).fill_null("")
            size = np.cumsum(pc.binary_length(texts).to_numpy())
            cuts = np.flatnonzero(np.diff(size // _SLICE_BYTES)) + 1
            total = np.zeros(0, np.int64)
            for begin, end in zip([0, *cuts], [*cuts, len(texts)]):
                if begin < end:
                    rows, ids = encoder.encode(texts[begin:end], end_id)
                    counts = np.bincount(ids, minlength=len(total))
                    counts[:len(total)] += total
                    total = counts
                    packed = [None] * (end - begin - 1) + [pack_counts(total) if end == len(texts) else None]
                    yield pa.RecordBatch.from_arrays([batch.column(0)[begin:end], rows.cast(pa.binary()), pa.array(packed, pa.binary())], ["id", "ids", "counts"])
    return run
