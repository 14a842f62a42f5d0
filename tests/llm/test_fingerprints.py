import hashlib
import random

import regex

from pyspark.sql import functions as F

from chatmill.llm import fingerprints as fp

SCHEMA = "doc_id long, text string"


def _run(spark, rows, **kw):
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("fingerprint", F.lit("clash")).withColumn("_g", F.lit(1))
    return fp.fingerprint_documents(docs, **kw).collect()


def test_edited_text_against_brute_force(spark):
    rows = [(i * 37 % 1009, ("Wörter hier. " * (i % 9) + f"doc {i}\n" * (i % 4) + "é" * (i % 3))) for i in range(1, 400)]
    bounds = fp.range_bounds(spark.createDataFrame(rows, SCHEMA), F.col("doc_id"), 50)
    assert len(bounds) > 4
    got = {r.doc_id: r for r in fp.fingerprint_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    down = sorted(rows, reverse=True)
    for (i, t), (_, nxt) in zip(down, down[1:] + down[:1]):
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (r.fingerprint == r.edited_fingerprint) == (t == edited)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def _plain(text):
    """The fingerprint, restated: leaves, paragraphs, sections, root; and its leaves."""
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    sections, paragraphs, leaves = [], [], []

    def close_paragraph():
        if leaves:
            paragraphs.append(list(leaves))
            leaves.clear()

    def close_section():
        close_paragraph()
        if paragraphs:
            sections.append(list(paragraphs))
            paragraphs.clear()

    for clause in regex.findall(fp._CLAUSE, text, flags=regex.ASCII):
        leaves.append(md5(clause))
        if "\n\n" in clause or not clause.strip(" \t\r\n"):
            close_section()
        elif clause.endswith("\n"):
            close_paragraph()
    close_section()
    nodes = [md5("".join(md5("".join(p)) for p in s)) for s in sections]
    shown = ";".join(n[:8] + "(" + ",".join(md5("".join(p))[:8] + "=" + ".".join(x[:10] for x in p) for p in s) + ")" for n, s in zip(nodes, sections))
    return hashlib.sha256("".join(nodes).encode()).hexdigest() + ":" + shown, {x[:10] for s in sections for p in s for x in p}


def _alike(a, b):
    (fa, la), (fb, lb) = _plain(a), _plain(b)
    return 1.0 if fa == fb else 2 * len(la & lb) / (len(la) + len(lb)) if la or lb else 0.0


def test_fingerprint_and_likeness_against_brute_force(spark):
    rnd = random.Random(8)
    words = ["Wort", "é.", "a", "b!", "one?", "two", "\n", "\n\n", " ", "c.\n", "\t", "🙂"]
    rows = [(i, "".join(rnd.choice(words) + rnd.choice([" ", ""]) for _ in range(rnd.randrange(60)))) for i in range(150)] + [(200, ""), (201, None), (202, "x " * 3000)]
    got = {r.doc_id: r for r in fp.fingerprint_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    down = sorted(((i, t or "") for i, t in rows), reverse=True)
    for (i, t), (_, nxt) in zip(down, down[1:] + down[:1]):
        half = len(t) // 2
        edited, r = t[:len(t) - half] + nxt[:half], got[i]
        assert (r.fingerprint, r.edited_fingerprint) == (_plain(t)[0], _plain(edited)[0])
        assert abs(r.near_edited - _alike(t, edited)) < 1e-12 and abs(r.near_next - _alike(t, nxt)) < 1e-12


def test_changes_are_looked_for_below_what_differs(spark):
    a = "One.\nTwo two.\n\nThree.\nFour.\n\nFive."
    cases = [(a, 0), (a.replace("Four", "4"), 1), (a.replace("One", "1").replace("Five", "5"), 2), (a + " Six.\nSeven.", 2), ("", 0)]
    df = spark.createDataFrame([(a, b) for b, _ in cases], "a string, b string")
    df = fp.with_fingerprint(fp.with_fingerprint(df, F.col("a"), "fa"), F.col("b"), "fb")
    got = [r.c for r in df.select(fp.changed_paragraphs(F.col("fb"), F.col("fa")).alias("c")).collect()]
    assert [len(c) for c in got] == [n for _, n in cases]


def test_ranges_do_not_change_the_result(spark):
    rows = [(i, f"a{i} " * 30) for i in range(60)] + [(7, "twin"), (7, "twin"), (None, "no id")]
    docs = spark.createDataFrame(rows, SCHEMA)
    few = fp.with_next(docs.withColumn("text", F.coalesce("text", F.lit(""))), 1_000)
    many = fp.with_next(docs.withColumn("text", F.coalesce("text", F.lit(""))), 3)
    pick = lambda d: sorted((r.doc_id if r.doc_id is not None else -1, r.text, r.next_text) for r in d.collect())
    assert pick(few) == pick(many) and len(pick(many)) == len(rows)


def test_equality_order_and_likeness(spark):
    a = "One two three.\nFour five six seven.\n\nEight nine ten." * 5
    rows = [(1, a), (2, a), (3, a.replace("nine", "9", 1)), (4, ""), (5, None), (6, "Totally other words here")]
    got = {r.doc_id: r for r in _run(spark, rows)}
    assert got[1].fingerprint == got[2].fingerprint != got[3].fingerprint
    assert got[2].near_next == 1.0 and 0.4 < got[3].near_next < 1.0      # 3 is followed by 2
    assert got[4].fingerprint == got[5].fingerprint and got[5].near_next == 1.0
    assert got[6].near_next == 0.0
    changed = fp.with_fingerprint(fp.with_fingerprint(spark.createDataFrame([(rows[0][1], rows[2][1])], "a string, b string"), F.col("a"), "fa"), F.col("b"), "fb")
    assert len(changed.select(fp.changed_paragraphs(F.col("fb"), F.col("fa")).alias("c")).first().c) == 1


def test_leaves_are_the_text_and_long_texts_pass(spark):
    texts = ["", " ", "\n\n", " a  b\n \n c.", "x" * 300_000, "w " * 200_000, "Ünï. Çode!\r\nline\t\n\n\nend"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.array_join(fp.clauses(F.col("t")), "").alias("j")).collect()
    assert all(r.t == r.j for r in rows)


def test_single_row_and_empty_table(spark):
    r = _run(spark, [(1, "abcd")])[0]
    assert r.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and r.near_next == 1.0
    assert _run(spark, []) == []
    assert len(_run(spark, [(None, "a"), (None, "b")])) == 2
