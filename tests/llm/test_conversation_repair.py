"""op11 against a plain search over all edits."""

import hashlib
import random
import zlib
from functools import lru_cache

from chatmill.llm import conversation_repair
from chatmill.llm.turn_alignment import RUN, Between, Fold

SPACE = " \t\n\x0b\f\r"
WORDS = {"u": "user", "a": "assistant"}


def search(turns):
    """Least (cost, audit, repaired) over every sequence of edits."""
    faults, seen = [], set()
    for role, text in turns:
        bare = text.rstrip(SPACE)
        faults.append("b" if not bare.strip(SPACE) else "d" if (role, text) in seen else "" if bare[-1] in ".!?" else "t")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, last, inserted):
        found = [(0, "", ())] if i == len(turns) and last in ("", "a") else []

        def take(cost, letter, line, rest):
            if rest:
                found.append((cost + rest[0], letter + rest[1], (line, *rest[2]) if line is not None else rest[2]))

        expected = "a" if last == "u" else "u"
        if i < len(turns):
            role, text = turns[i]
            take(4, "D", None, best(i + 1, last, 0))
            if faults[i] not in ("b", "d"):
                extra = 3 if faults[i] == "t" else 0
                if (role[:1] == "s" and last == "") or role[:1] == expected:
                    take(extra, "K", f"{role}:{text}", best(i + 1, role[:1], 0))
                take(extra + 3, "R", f"{WORDS[expected]}:{text}", best(i + 1, expected, 0))
        if inserted < 4:
            take(3, "I", f"{WORDS[expected]}:", best(i, expected, inserted + 1))
        return min(found, default=None)

    cost, audit, lines = best(0, "", 0)
    return faults, cost, audit, "\n".join(lines)


def expected(rows):
    """rows: (turn, role, text) after damage."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, cost, audit, text = search([r[1:] for r in rows])
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def some_rows(n_conv, seed):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(n_conv)]:
        for turn in range(rng.choice([0, 1, 2, 5, 9, 14])):
            role = rng.choice(["system", "user", "assistant", "tool", "", None]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            text = rng.choice([None, "", " \t", "Yes.", "No", "é!", "Why? \n", "x ", "long " * 50 + "end."])
            rows.append((conv, rng.choice([turn, turn + 1, None]) if rng.random() < 0.2 else turn, role, text))
    return rows


FIELDS = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def test_against_search(spark):
    rows = some_rows(150, 1)
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS cost", "2 AS part", "'x' AS run", "3 AS conv")
    got = {r.conv_id: tuple(r[f] for f in FIELDS) for r in conversation_repair.repair_conversations(conversation_repair.damage(docs)).collect()}
    left = damaged(rows)
    assert set(got) == {r[0] for r in left}
    for conv in got:
        assert got[conv] == expected([r[1:] for r in left if r[0] == conv]), conv


def test_query_returns_conversations_without_turns(spark, tmp_path):
    from chatmill.llm.queries import op11_conversation_repair
    rows = some_rows(60, 2) + [(c, 0, "user", "Lost.") for c in range(1000, 1100)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r[f] for f in FIELDS) for r in op11_conversation_repair(spark, str(tmp_path)).collect()}
    left = damaged(rows)
    assert set(got) == {r[0] for r in rows}
    gone = [c for c in got if not any(r[0] == c for r in left)]
    assert gone
    for conv in got:
        assert got[conv] == (expected([r[1:] for r in left if r[0] == conv]) if conv not in gone else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))


def test_one_conversation_over_all_ranges(spark):
    """A third of the turns and more in one conversation: its runs meet in a fold; repeats far apart are found."""
    rng = random.Random(3)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"Text {rng.randrange(150)}" + rng.choice([".", ""])) for t in range(400)]
    rows += [(c, t, "ua"[t % 2], "Fine.") for c in (1, 9) for t in range(2)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = conversation_repair.repair_conversations(docs, with_text=True)
    got = {r.conv_id: r for r in out.collect()}
    assert len(got) == 3
    assert tuple(got[7][f] for f in FIELDS) == expected([r[1:] for r in rows if r[0] == 7])
    assert hashlib.sha256(got[7].repaired.encode()).hexdigest() == got[7].repaired_sha256


def test_long_conversation_within_a_range(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "MAX_HELD", RUN)
    rows = [(c, t, ("user", "assistant")[t % 2 if t % 7 else 0], f"Turn {t % 60}.") for c in range(4) for t in range(150)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        got = {r.conv_id: tuple(r[f] for f in FIELDS) for r in conversation_repair.repair_conversations(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert got == {c: expected([r[1:] for r in rows if r[0] == c]) for c in range(4)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_repair.repair_conversations(docs).count() == 0


def test_runs_of_any_size_give_one_result():
    rng = random.Random(4)
    between = Between()
    for _ in range(60):
        n = rng.randrange(1, 14)
        turns = [(rng.choice(["system", "user", "assistant", "x"]), rng.choice([f"{i}.", f"{i}", "same.", " "])) for i in range(n)]
        faults, cost, audit, text = search(turns)
        faults = "".join(f or "." for f in faults)
        initials = "".join(r[:1] for r, _ in turns)
        for size in (1, 3, RUN):
            fold = Fold(between, True)
            for at in range(0, n, size):
                fold.push(list(range(at, min(n, at + size))), initials[at:at + size], faults[at:at + size], [r for r, _ in turns[at:at + size]], [x for _, x in turns[at:at + size]])
            got = fold.finish()
            assert (got["cost"], got["audit"], got["repaired"]) == (cost, audit, text)
