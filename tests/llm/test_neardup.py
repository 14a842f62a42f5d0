import itertools
import random
import re

from chatmill.llm import neardup, shingle_sets
from chatmill.llm.components import components


def _sets(rows, size):
    out = {}
    for i, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    return out


def _brute(rows, size, percent=80):
    s = _sets(rows, size)
    up = {i: i for i in s}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(s, 2):
        both = len(s[a] & s[b])
        if both and 100 * both >= percent * len(s[a] | s[b]):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(s[i]), root(i)) for i in s}


def _check(spark, rows, size):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS key", "3 AS kept", "4 AS node")
    got = neardup.near_duplicates(docs, size=size).collect()
    want = _brute(rows, size)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)
    return want


def test_against_brute_force_with_chains_and_a_large_group(spark):
    rnd = random.Random(5)
    text = lambda n: [f"w{rnd.randrange(5000)}" for _ in range(n)]
    rows, base = [], text(120)
    for i in range(80):                       # a group whose members drift: chains of links
        rows.append((i, " ".join(base)))
        for _ in range(2):
            base[rnd.randrange(len(base))] = f"d{i}"
    hot = text(60)
    for i in range(80, 160):                  # many alike, not equal
        w = list(hot)
        w[rnd.randrange(60)] = f"h{i}"
        rows.append((i, " ".join(w)))
    boiler = text(30)
    for i in range(160, 220):                 # share half a text: candidates without links
        rows.append((i, " ".join(boiler + text(25))))
    rows += [(300 + i, t) for i, t in enumerate(["", None, " \n", "One two", "one  TWO", "one", "É two three four", "é two three four", "a b c d", "A b\tc\nd"])]
    rows += [(400, "x y z " * 30_000), (401, "x y z " * 29_000)]
    rnd.shuffle(rows)
    want = _check(spark, rows, 4)
    assert want[304][1] == 303 and want[401][1] == 400 and want[307][1] == 307 and want[301][1] == 301


def test_nulls_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (None, None)], "doc_id long, text string")
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == 5 and [r.component_id for r in got if r.doc_id == 3] == [None]
    assert neardup.near_duplicates(docs.where("false")).count() == 0
    assert neardup.drop_near_duplicates(docs.where("doc_id IS NOT NULL")).count() == 1


def test_signature_is_exact_and_unbiased():
    import numpy as np
    rnd = np.random.default_rng(1)
    u = rnd.integers(0, 2**64, 20_000, np.uint64)
    f, b = rnd.integers(0, 2**64, 64, np.uint64) | np.uint64(1), rnd.integers(0, 2**64, 64, np.uint64)
    sig = shingle_sets.signature(u, f, b)
    assert (sig[:, 0] == ((u[:, None] ^ b) * f).min(0)).all() and (sig[:, 1] == ((u[:, None] ^ b) * f).max(0)).all()
    alike = (shingle_sets.signature(u[:16_000], f, b) == shingle_sets.signature(u[2_000:18_000], f, b)).mean()
    assert abs(alike - 14 / 18) < 0.12


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100)], "a long, b long")
    labels, _ = components(links)
    got = {r.node: r.label for r in labels.collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_rows_are_judged_by_their_own_text(spark):
    far, near = "a b c d e f g h", " ".join(f"w{i}" for i in range(60))
    rows = [(1, far, 0), (7, far, 1), (7, "q r s t u v", 2), (7, "", 3),          # two texts and none under one id
            (None, near, 4), (None, near + " x", 5), (None, near, 6), (None, "k l m n o p", 7), (9, near + " y", 8), (None, None, 9), (None, None, 10),
            (0, "i j k l m n", 11), (0, "i j k l m n", 12), (0, "I  j k l m n", 13)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tag int")
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == len(rows) and sum(r.kept for r in got) == 8
    left = neardup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    tags = {r.tag for r in left.collect()}
    assert len(tags) == left.count() == 8 and {0, 2, 3, 7, 9, 10} < tags
    assert len(tags & {4, 5, 6}) == 1 and len(tags & {11, 12, 13}) == 1


def _compared(spark, monkeypatch, rows):
    """How many pairs of texts are compared, and the result."""
    seen, staged = [], neardup.staged

    def counted(df, label):
        out = staged(df, label)
        if label == "pairs":
            seen.append(out[0].count())
        return out
    monkeypatch.setattr(neardup, "staged", counted)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=4).collect()
    monkeypatch.setattr(neardup, "staged", staged)
    return sum(seen), {r.doc_id: (r.n_shingles, r.component_id) for r in got}


def test_unlinked_documents_of_one_template_are_not_compared_in_pairs(spark, monkeypatch):
    """70 of 80 words in common, no two linked: comparisons grow with the documents."""
    rnd = random.Random(11)
    shared = [f"w{i}" for i in range(70)]
    counts = {}
    for n in (100, 400):
        rows = []
        for i in range(n):
            at = rnd.randrange(71)
            rows.append((i, " ".join(shared[:at] + [f"u{i}x{j}" for j in range(10)] + shared[at:])))
        counts[n], got = _compared(spark, monkeypatch, rows)
        assert all(c == i for i, (_, c) in got.items())
    assert counts[400] <= 30 * 400 and counts[400] < 8 * counts[100] < 8 * 30 * 100


def test_sizes_and_places_lose_no_link(spark):
    """Pairs about the threshold, of unequal sizes, in one template."""
    rnd = random.Random(12)
    shared = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(150):
        w = list(shared)
        for _ in range(rnd.randrange(5)):
            w[rnd.randrange(len(w))] = f"v{rnd.randrange(40)}"
        w = w[rnd.randrange(12):len(w) - rnd.randrange(12)]
        rows.append((i, " ".join(w)))
    _check(spark, rows, 4)
