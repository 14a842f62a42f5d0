import random
import re

from chatmill.llm import decontaminate as dc


def _words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def _grams(w, n):
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def _brute(docs, items, t=0.8):
    out = {}
    for i, x in items:
        w = _words(x)
        if not w:
            continue
        q = _grams(w, min(5, len(w)))
        for d, y in docs:
            s = len(q & _grams(_words(y), min(5, len(w))))
            if s / len(q) >= t:
                out[d, i] = max(out.get((d, i), (0, 0)), (s, len(q)))
    return out


def test_against_brute_force(spark):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rnd.choices(vocab, k=n))
    items = [(i, text(rnd.randint(1, 60))) for i in range(60)] + [(60, None), (61, ""), (62, "?!")]
    docs = []
    for d in range(200):
        body = text(rnd.randint(0, 300)).split()
        if d % 3 == 0:
            w = items[rnd.randrange(60)][1].split()
            for _ in range(rnd.randint(0, 2)):
                w[rnd.randrange(len(w))] = "zz"
            at = rnd.randint(0, len(body))
            body[at:at] = w
        docs.append((d, " ".join(body)))
    docs += [(200, None), (201, ""), (202, (text(40_000) + " " + items[30][1].upper() + ".")), (None, items[31][1])]
    dd = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS words", "3 AS value")
    ii = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id")
    got = {(r.doc_id, r.item_id): (r.n_shared, r.n_item) for r in dc.find_leaks(dd, ii).collect()}
    want = _brute(docs, items)
    assert got == want and len(want) > 60
    kept = {r.doc_id for r in dc.drop_leaks(dd, ii).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


def test_repeated_rows_and_empty_tables(spark):
    s = "a b c d e f g h"
    dd = spark.createDataFrame([(1, s), (1, s), (1, "x")], "doc_id long, text string")
    ii = spark.createDataFrame([(1, s), (1, s)], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.containment) for r in dc.find_leaks(dd, ii).collect()] == [(1, 1, 1.0)]
    assert dc.find_leaks(dd, ii.where("false")).count() == 0 and dc.find_leaks(dd.where("false"), ii).count() == 0
    assert dc.drop_leaks(dd, ii.where("false")).count() == 3


def test_shuffle_join_gives_the_same(spark, monkeypatch):
    dd = spark.createDataFrame([(1, "a b c d e f"), (2, "q")], "doc_id long, text string")
    ii = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    monkeypatch.setattr(dc, "MAX_BROADCAST_SKETCH", 0)
    assert dc.find_leaks(dd, ii).count() == 1


def test_rows_are_dropped_by_their_own_text(spark):
    s = "a b c d e f g h"
    dd = spark.createDataFrame([(None, "clean one"), (None, "x " + s), (None, None), (1, s), (1, "clean two"), (2, s + " y")], "doc_id long, text string")
    ii = spark.createDataFrame([(1, s)], "item_id long, text string")
    assert sorted((r.doc_id or 0, r.text or "") for r in dc.drop_leaks(dd, ii).collect()) == [(0, ""), (0, "clean one"), (1, "clean two")]
