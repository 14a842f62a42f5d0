import numpy as np
from pyspark.sql import functions as F

from chatmill.llm import quality, quality_terms, toxic_words, toxicity
from chatmill.llm.queries import op2_toxicity, op6_quality

SF = "/root/testdata/sf0.01"


def _held_out(spark, rows, label, threshold):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = rows.collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= threshold) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    return sum(p == y for p, y in held) / len(held)


def test_held_out_accuracy(spark):
    assert _held_out(spark, op2_toxicity(spark, SF), "toxic", 0.5) > 0.9
    assert _held_out(spark, op6_quality(spark, SF), "quality", 0.7) > 0.9


def test_the_penalty_spares_neutral_mentions(spark):
    rows = [(i, f"these {g} are {w} w{i % 7}", int(w == "scum")) for i, (g, w) in enumerate(
        [("muslims", "scum")] * 40 + [("muslims", "kind")] * 10 + [("christians", "kind")] * 40 + [("christians", "scum")] * 5)]
    texts = spark.createDataFrame(rows, "id long, text string, label int")
    probe = spark.createDataFrame([(1, "muslims here"), (2, "christians here"), (3, "scum here")], "doc_id long, text string")
    plain, fair = (toxicity.train(texts, penalty=p) for p in (0.0, 10.0))
    score = lambda m: {r.doc_id: r.score for r in toxicity.score(probe, m).collect()}
    before, after = score(plain), score(fair)
    assert before[1] - before[2] > 3 * abs(after[1] - after[2]) and after[1] < before[1] and after[3] > 0.5


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "scum " * 50_000), (4, "fine words")], "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS label", "3 AS id")
    labels = spark.createDataFrame([(1, 1, 0), (2, None, None), (4, 0, 1), (77, 1, 1)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.where("false")):
        model = toxicity.fit_to(docs, some)
        got = toxicity.score(docs, model).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
        assert toxicity.drop_toxic(docs, model).columns == docs.columns
        got = quality.score_quality(docs, some).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
        assert toxicity.score(docs.where("false"), model).count() == 0 and quality.score_quality(docs.where("false"), some).count() == 0


def test_folds(spark):
    import zlib
    got = spark.range(200).select("id", toxicity.fold(F.col("id"), 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in got)


def test_votes_are_exact():
    import pyarrow as pa

    class Model:
        pass

    rnd = np.random.default_rng(3)
    axes, known = np.eye(quality_terms.DIMS, 8, dtype=np.float32), quality_terms.unit(rnd.normal(size=(50, 8)).astype(np.float32))
    labels, m = rnd.integers(0, 2, 50).astype(np.float64), Model()
    m.value = (np.ones(quality_terms.DIMS, np.float32), axes, known, labels)
    x = rnd.integers(1, 255, size=(9, 8)).astype(np.uint8)
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array([np.arange(8, dtype="<u2").tobytes()] * 9, pa.binary()), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "terms", "values"])
    got = next(quality_terms.voter(m, 5, 2.0, block=4)(iter([batch])))["score"].to_pylist()
    for r, s in zip(quality_terms.unit(x.astype(np.float32)), got):
        near = known @ r
        top = np.argsort(near)[-5:]
        w = np.maximum(near[top], 0) ** 2
        assert abs(s - (w * labels[top]).sum() / w.sum()) < 1e-5


def test_swap_is_within_groups():
    swap = toxic_words.SWAP
    assert toxic_words.counterfactuals("Muslim tree", swap) == [{"christian", "tree"}]
    assert toxic_words.counterfactuals("women and men", swap) == [{"women", "and"}, {"men", "and"}]      # a whole line has its own
    assert toxic_words.counterfactuals("und Frauen, hommes", swap) == [{"und", "männer", "hommes"}, {"und", "frauen", "femmes"}]
    assert toxic_words.counterfactuals(None, swap) == [] and set(swap) == set(swap.values())


def test_the_penalty_acts_on_the_rows_that_name_groups(spark):
    """How many rows are swapped, own identity lines, and texts that name a whole line."""
    rows = [(i, t, y) for i, (t, y) in enumerate([("zorg scum here", 1)] * 30 + [("zorg kind", 0)] * 5 + [("blip kind", 0)] * 30 + [("zorg and blip kind", 0)] * 10 + [("nothing", 0)] * 25)]
    texts = spark.createDataFrame(rows, "id long, text string, label int")
    own = toxicity.train(texts, identity_terms=(("zorg", "blip"),))
    assert (own.rows, own.swapped_rows) == (100, 75)
    plain = toxicity.train(texts)
    assert (plain.rows, plain.swapped_rows) == (100, 0)
    probe = spark.createDataFrame([(1, "zorg kind"), (2, "blip kind"), (3, "zorg scum")], "doc_id long, text string")
    score = lambda m: {r.doc_id: r.score for r in toxicity.score(probe, m).collect()}
    a, b = score(plain), score(own)
    assert b[1] - b[2] < 0.5 * (a[1] - a[2]) and b[3] > 0.5 > b[1]


def test_scores_are_those_of_the_weights(spark):
    """The scorer against a plain sum over the words, their beginnings and endings."""
    features = ["scum", "-cumb", "fool-", "nice"]
    model = toxicity.Model(features, [2.0, 1.0, 0.5, -1.0], -0.25)
    texts = ["scum", "Scum scum SCUM", "foolish nice", "succumb", None, "", "nothing"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for i, t in enumerate(texts):
        words = {w.lower() for w in (t or "").split()}
        found = {f for w in words for f in [w] + [x for k in (4, 5, 6) if len(w) > k for x in (w[:k] + "-", "-" + w[-k:])]}
        logit = -0.25 + sum(w for f, w in zip(features, model.weights) if f in found)
        assert abs(got[i] - 1 / (1 + np.exp(-logit))) < 1e-12


def test_vectors_hold_words_and_pairs():
    """Texts of one shape and other words have other terms; each against a plain count."""
    import xxhash
    a, b = "The quick brown fox jumps.", "Xyz qqqqq wwwww eee rrrrr."
    assert quality_terms.counts_of(a, {}) == quality_terms.counts_of(b, {})
    (ta, va), (tb, _) = (quality_terms.word_terms(t, {}) for t in (a, b))
    assert len(set(ta) & set(tb)) <= 2 and set(ta).isdisjoint(range(quality_terms.SHAPES))
    words = ["the", "quick", "brown", "fox", "jumps"]
    own = {int(quality_terms.SHAPES + quality_terms.mixed(np.array([xxhash.xxh64_intdigest(w)], np.uint64))[0] % np.uint64(quality_terms.WORDS)) for w in words}
    assert own <= set(ta.tolist()) and len(ta) <= 9 and abs(va.min() - np.log1p(20)) < 1e-9
    assert [len(x) for x in quality_terms.word_terms(None, {})] == [0, 0]
    near = quality_terms.word_terms("quick the", {})[0]
    assert set(near) & own and not set(near) <= set(ta)                  # the pair is another


def test_axes_are_the_leading_singular_vectors():
    rnd = np.random.default_rng(4)
    x = (rnd.normal(size=(200, 12)) * np.linspace(9, 1, 12)) @ rnd.normal(size=(12, 300)) + 0.01 * rnd.normal(size=(200, 300))
    got = quality_terms.latent_axes(x.astype(np.float32), 6)
    _, _, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(np.abs(np.sum(got.T * vt[:6], 1)), 1, atol=1e-3)
    assert quality_terms.latent_axes(np.zeros((0, 300), np.float32), 6).shape == (300, 6)
    assert quality_terms.latent_axes(x[:3].astype(np.float32), 6).shape == (300, 3)
