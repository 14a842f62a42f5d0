import random

import corpus_pipeline
from chatmill.llm.common import staged

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_planted_cases(spark, tmp_path):
    rnd = random.Random(11)
    text = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 9))) for _ in range(n))
    clean = {i: text(80) for i in range(60)}
    passage, item = text(60), text(30)
    texts = dict(clean)
    texts |= {100 + i: text(40) + " moron scum " + text(20) for i in range(30)}                      # toxic
    texts |= {200: clean[3], 201: clean[4] + " extra", 202: None, 203: ""}                           # copies, no text
    texts |= {300: text(50) + " " + passage, 301: text(50) + " " + passage + " " + text(9)}          # a repeated passage
    texts |= {400: text(40) + " " + item + " " + text(40)}                                           # a benchmark item
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    d = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(100 <= i < 200)) for i in [*range(60), *range(100, 125)]], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")

    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs, _ = staged(stage(spark, docs, d), f"test-{name}")
        seen.append({r.doc_id: r for r in docs.collect()})
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    toxic, near, cut, leak, tokens = seen
    assert set(texts) - set(toxic) == set(range(100, 130))
    assert set(toxic) - set(near) == {200, 201}
    assert set(cut) == set(near) and passage in cut[300].text and passage not in cut[301].text
    assert all(cut[i].text == clean[i] and cut[i].n_chars == len(clean[i]) for i in clean)
    assert set(cut) - set(leak) == {400}
    assert set(tokens) == set(leak) and all(r.exact and r.n_tokens == len(r.ids) for r in tokens.values())


def test_run_and_empty_documents(spark, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    assert corpus_pipeline.run(spark, d).count() == 0


def test_edge_rows_of_every_stage(spark, tmp_path):
    """Nulls in any column, empty and very long texts, repeated rows and ids, further columns with clashing names."""
    d = str(tmp_path)
    long, other = "lorem ipsum dolor sit amet " * 20_000, "some words that no other document has in common with it"
    rows = [(None, None, None, None, None), (None, other, "en", None, None), (1, "", None, "s", 0), (1, "", None, "s", 0), (2, None, "en", "s", None),
            (3, long, "en", "s", len(long)), (4, "one two three four five six", None, None, 27), (4, "another text under the same id as before it", "de", "s", None),
            (5, "one two three four five six", "en", "s", 27), (6, "scum moron scum", "en", "s", 15), (6, "scum moron scum", "en", "s", 15)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "'x' AS kept", "2 AS h", "'y' AS node", "3 AS chunk", "4 AS score", "'z' AS label")
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(6, None, 1), (4, 1, 0), (None, 1, None), (None, None, 0), (3, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, None), (None, ""), (2, "no such item in any of the documents here")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs, sizes = spark.read.parquet(f"{d}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs, _ = staged(stage(spark, docs, d), f"edge-{name}")
        sizes.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert sizes[0] >= 9 and sizes[1] in (sizes[0] - 1, sizes[0] - 2) and sizes[1] == sizes[2] == sizes[3] == sizes[4]
    got = docs.collect()
    assert all(r.exact and r.n_tokens == len(r.ids) for r in got)
    assert sum(r.doc_id is None for r in got) == 2 and max(r.n_tokens for r in got) > 50_000
