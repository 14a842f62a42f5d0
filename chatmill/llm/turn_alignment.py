"""Cheapest edits that fit a run of turns to the grammar (s?(ua)+)?.

A run is one letter a turn: its role's initial (x: any other), a capital if the
text is truncated, d if the turn has to go. The run is aligned to every length
of the alternating string that can be the cheapest: a Wagner-Fischer table,
kept to the diagonals whose bound is within the cost of the best alignment so
far (Ukkonen's band), then traced back along the least letters of D, I, K, R.

Runs are aligned between grammar states, so that a conversation of any length
is a fold over runs of ``RUN`` turns: a run's letters end with a turn's own
(insertions stand in front of a turn, or at the conversation's end), so no
result is the beginning of another and the least of the parts is the least of
the whole.
"""

from __future__ import annotations

import hashlib

RUN = 48
INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
#: Grammar states: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
_INF = 1 << 60
#: (state, state) -> the shortest strings between them; more of the same is a pair longer.
_SHORTEST = {
    (START, START): ("",), (START, SYSTEM): ("s",), (START, USER): ("u", "su"), (START, ASSISTANT): ("ua", "sua"),
    (SYSTEM, SYSTEM): ("",), (SYSTEM, USER): ("u",), (SYSTEM, ASSISTANT): ("ua",),
    (USER, USER): ("",), (USER, ASSISTANT): ("a",), (ASSISTANT, ASSISTANT): ("",), (ASSISTANT, USER): ("u",)}
_ALTERNATES = {(START, USER), (START, ASSISTANT), (SYSTEM, USER), (SYSTEM, ASSISTANT), (USER, USER), (USER, ASSISTANT), (ASSISTANT, ASSISTANT), (ASSISTANT, USER)}
#: What completes the grammar from a state.
_CLOSING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
ROLES = {"u": "user", "a": "assistant"}


def _least(turns: int, gone: int, cut: int, length: int) -> int:
    """No alignment of a run to so many turns is cheaper."""
    over = turns - gone - length
    return DELETE * gone + TRUNCATED * cut + (min(over, cut) * (DELETE - TRUNCATED) + max(0, over - cut) * DELETE if over > 0 else -over * INSERT)


def align(run: str, target: str, limit: int) -> tuple[int, str] | None:
    """The least cost up to ``limit``, with the least letters; the last letter is a turn's."""
    n, length = len(run), len(target)
    gone, cut = run.count("d"), sum(map(str.isupper, run))
    spare = limit - _least(n, gone, cut, length)
    if spare < 0:
        return None
    # leaving the diagonals between the corners by one costs a deletion and an insertion more
    width = spare // (INSERT + (DELETE - TRUNCATED if cut else DELETE))
    free = [0]
    for c in run:
        free.append(free[-1] + (c != "d"))
    low, high = min(0, length - free[n]) - width, max(0, length - free[n]) + width
    table = [[_INF] * (length + 2) for _ in range(n + 1)]
    table[n][length] = 0
    for i in range(n - 1, -1, -1):
        here, below, c = table[i], table[i + 1], run[i]
        extra = TRUNCATED if c.isupper() else 0
        letter = c.lower()
        for j in range(min(length, free[i] + high), max(0, free[i] + low) - 1, -1):
            best = DELETE + below[j]
            if j < length:
                t = target[j]
                if t != "s" and INSERT + here[j + 1] < best:
                    best = INSERT + here[j + 1]
                if c != "d" and (letter == t or t != "s"):
                    stay = extra + below[j + 1] + (0 if letter == t else REROLE)
                    if stay < best:
                        best = stay
            here[j] = best
    cost = table[0][0]
    if cost > limit:
        return None
    letters, i, j = [], 0, 0
    while i < n:
        rest = table[i][j]
        if DELETE + table[i + 1][j] == rest:
            letters.append("D")
            i += 1
        elif j < length and target[j] != "s" and INSERT + table[i][j + 1] == rest:
            letters.append("I")
            j += 1
        else:
            letters.append("K" if run[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return cost, "".join(letters)


class Between:
    """(cost, letters) of a run's cheapest way from one state to another;
    results are remembered, up to a bound."""

    def __init__(self):
        self.known = {}

    def __call__(self, run: str, begin: int, end: int) -> tuple[int, str] | None:
        key = run, begin, end
        if key not in self.known:
            if len(self.known) >= 1 << 16:
                self.known.clear()
            self.known[key] = self._best(*key)
        return self.known[key]

    @staticmethod
    def _best(run: str, begin: int, end: int) -> tuple[int, str] | None:
        n, gone, cut = len(run), run.count("d"), sum(map(str.isupper, run))
        dearest = DELETE * n + INSERT * 3
        targets = []
        for shortest in _SHORTEST.get((begin, end), ()):
            pair = {"u": "au", "a": "ua"}.get(shortest[-1:], "ua" if begin == ASSISTANT else "au")
            target = shortest
            while (least := _least(n, gone, cut, len(target))) <= dearest or len(target) < n:
                targets.append((least, target))
                if (begin, end) not in _ALTERNATES:
                    break
                target += pair
        best = None
        for least, target in sorted(targets):
            if best and least > best[0]:
                break
            found = align(run, target, best[0] if best else dearest)
            if found and (best is None or found < best):
                best = found
        return best


def repaired(letters: str, roles: list[str], texts: list[str], state: int) -> tuple[list[str], int]:
    """The repaired turns as role:text, and the state after them; ``letters``
    may hold insertions behind the last turn."""
    out, at = [], 0
    for x in letters:
        if x in "KR":
            role, text = roles[at], texts[at]
            at += 1
        elif x == "D":
            at += 1
            continue
        expected = "a" if state == USER else "u"
        if x == "K":
            state = {"s": SYSTEM, "u": USER}.get(role[:1], ASSISTANT)
        else:
            role, text = ROLES[expected], text if x == "R" else ""
            state = USER if expected == "u" else ASSISTANT
        out.append(f"{role}:{text}")
    return out, state


class Fold:
    """A conversation, run by run: for every state the cheapest way so far, its
    letters and the digest of its repaired text. Memory does not grow with the
    conversation, but for the letters (and the text, if it is asked for)."""

    def __init__(self, between: Between, with_text: bool = False):
        self.between, self.with_text = between, with_text
        self.ways = {START: (0, 0, (None, ""), hashlib.sha256(), (None, ""))}   # cost, rank, letters, digest, text
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.last_initial = self.least_turn = self.last_turn = None

    def push(self, turns: list[int | None], initials: str, faults: str, roles: list[str], texts: list[str], known: dict | None = None) -> None:
        """One run, in order. ``faults``: b(lank), d(uplicate), t(runcated) or a
        point; ``known``: results of ``between``, if they were computed before."""
        self.blank += faults.count("b")
        self.duplicate += faults.count("d")
        self.truncated += faults.count("t")
        for turn in turns:
            if turn is not None and turn != self.last_turn:
                self.turns += 1
                self.least_turn = turn if self.least_turn is None else self.least_turn
                self.last_turn = turn
        joined = (self.last_initial or "") + initials
        self.illegal += sum(joined[i:i + 2] not in ("su", "ua", "au") for i in range(len(joined) - 1))
        self.last_initial = initials[-1:]
        run = letters_of(initials, faults)
        ways = {}
        for end in range(4):
            found = None
            for begin, way in self.ways.items():
                part = known.get((begin, end)) if known is not None else self.between(run, begin, end)
                if part and (found is None or (way[0] + part[0], way[1], part[1]) < found[:3]):
                    found = way[0] + part[0], way[1], part[1], begin
            if found:
                ways[end] = found
        ranks = {end: r for r, (_, _, end) in enumerate(sorted((w[1], w[2], end) for end, w in ways.items()))}
        after = {}
        for end, (cost, _, letters, begin) in ways.items():
            _, _, before, digest, text = self.ways[begin]
            piece, _ = repaired(letters, roles, texts, begin)
            after[end] = cost, ranks[end], *self._add(before, digest, text, letters, piece)
        self.ways = after

    def _add(self, letters, digest, text, more: str, piece: list[str]):
        if piece:
            joined = "\n".join(piece)
            if letters[2:] or text[2:]:
                joined = "\n" + joined
            digest = digest.copy()
            digest.update(joined.encode("utf-8", "surrogatepass"))
            return (letters, more, True), digest, (text, joined, True) if self.with_text else (None, "", True)
        return (letters, more, *letters[2:]), digest, text

    def finish(self) -> dict:
        """The contract's columns."""
        best = None
        for state, (cost, rank, letters, digest, text) in self.ways.items():
            closing = _CLOSING[state]
            key = cost + INSERT * len(closing), rank
            if best is None or key < best[0]:
                best = key, state, letters, digest, text, closing
        (cost, _), state, letters, digest, text, closing = best
        piece, _ = repaired(closing, [], [], state)
        letters, digest, text = self._add(letters, digest, text, closing, piece)
        gaps = self.last_turn - self.least_turn + 1 - self.turns if self.turns else 0
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
                "cost": cost, "audit": _joined(letters), "repaired_sha256": digest.hexdigest(), "repaired": _joined(text) if self.with_text else None}


def _joined(linked) -> str:
    parts = []
    while linked:
        parts.append(linked[1])
        linked = linked[0]
    return "".join(reversed(parts))


def letters_of(initials: str, faults: str) -> str:
    return "".join("d" if f in "bd" else c.upper() if f == "t" else c for c, f in zip(initials, faults))
