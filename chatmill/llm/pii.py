"""Personal data in whole texts: base spans by fixed patterns, and more by
boosted trees over freely proposed candidates; the parts are in
``pii_candidates`` and ``boosted_trees``.

No labels are given: right and wrong examples are made out of the base spans of
all documents and their changed copies. Trees learn from two thirds of the
documents; the others calibrate the scores and set, for every kind, the least
threshold that keeps ``PRECISION``.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import boosted_trees
from .common import discard, per_process, ship, staged
from .pii_candidates import FEATURES, KINDS, apart, base_spans, candidates, examples, features

#: Up to this many cells the driver adds them up itself, not a Spark job a level.
DRIVER_CELLS = 100_000
FOLDS, HELD_FOLD, PRECISION = 3, 0, 0.98
#: Fewer examples of a kind than this give no trees: only base spans are found.
LEAST_EXAMPLES = 200
#: Scores are calibrated in steps of 1 / this, up to the bound on either side.
SCORE_STEPS, SCORE_BOUND = 64, 32
_CELL = "kind int, held boolean, bins binary, n long, positives long"
_SPANS = "array<struct<kind: string, start: int, end: int, base: boolean, score: double>>"


def fit(docs: DataFrame, text_col: str = "text") -> dict:
    """Trees, calibration and threshold of each kind, out of all of ``docs``.

    A feature's bins end at exact quantiles of all examples to learn from. Trees
    know an example by its bins alone, so equal ones are counted (a cell), and
    every level of a tree is chosen by the sums over all cells: of one Spark job
    a level, or on the driver if there are few cells. Either way the trees are
    the same, in every run. Of the examples held out, the driver gets counts by
    score, in steps. A table without base spans gives no trees.
    """
    ship(per_process.__module__, boosted_trees.__name__, base_spans.__module__, __name__)
    spark = docs.sparkSession
    found, found_path = staged(docs.select(F.col(text_col).alias("text")).mapInArrow(_example_maker, "kind int, held boolean, label int, x array<double>"), "examples")
    counts = {(r["kind"], r["held"]): (r["n"], r["positives"]) for r in found.groupBy("kind", "held").agg(F.count("*").alias("n"), F.sum("label").alias("positives")).collect()}
    start = {}
    for k in range(len(KINDS)):
        (n, positives), (held, _) = (counts.get((k, h), (0, 0)) for h in (False, True))
        if n >= LEAST_EXAMPLES and held >= LEAST_EXAMPLES // 4 and 0 < positives < n:
            start[k] = boosted_trees.log_odds(positives, n)
    if not start:
        discard(spark, found_path)
        return {}
    edges = _edges(found.where(~F.col("held") & F.col("kind").isin(*start)), start)
    cells, cells_path = staged(found.mapInArrow(_binner(edges), _CELL).groupBy("kind", "held", "bins").agg(F.sum("n").alias("n"), F.sum("positives").alias("positives")), "cells")
    discard(spark, found_path)
    learn = cells.where(~F.col("held"))
    if learn.count() <= DRIVER_CELLS:
        here = list(_cells(learn.toArrow().combine_chunks().to_batches()))
        trees = boosted_trees.grow(edges, start, lambda growing, level: boosted_trees.sums(here, growing, level))
    else:
        trees = boosted_trees.grow(edges, start, lambda growing, level: _add_up(learn, growing, level))
    scores = cells.where("held").mapInArrow(_score_counter(edges, trees), "kind int, step int, n long, positives long")
    by_score = scores.groupBy("kind", "step").agg(F.sum("n").alias("n"), F.sum("positives").alias("positives")).orderBy("kind", "step").collect()
    discard(spark, cells_path)
    models = {}
    for k in start:
        step, n, positives = (np.array([r[c] for r in by_score if r["kind"] == k], float) for c in ("step", "n", "positives"))
        raw = step / SCORE_STEPS
        steps = boosted_trees.calibrate(raw, positives, n)
        models[k] = {"trees": trees[k], "steps": steps, "threshold": boosted_trees.threshold(boosted_trees.probability(steps, raw), positives, PRECISION, n),
                     "examples": counts[k, False][0], "held": counts[k, True][0]}
    return models


def _edges(found: DataFrame, kinds) -> dict[int, list[np.ndarray]]:
    """Per kind and feature, the exact quantiles that end its bins. Windows run
    over counted values, and a value is returned if it is one of the quantiles."""
    values = found.select("kind", F.posexplode("x").alias("feature", "value")).groupBy("kind", "feature", "value").agg(F.count("*").alias("n"))
    own = Window.partitionBy("kind", "feature")
    upto = F.sum("n").over(own.orderBy("value"))
    # the quantile q / BINS is the first value that has at least that share up to it
    ends = values.select("kind", "feature", "value", "n", upto.alias("upto"), F.sum("n").over(own).alias("all")).select(
        "kind", "feature", "value", F.floor((F.col("upto") - F.col("n")) * boosted_trees.BINS / F.col("all")).alias("before"),
        F.floor(F.col("upto") * boosted_trees.BINS / F.col("all")).alias("upto"))
    ends = ends.where((F.least("upto", F.lit(boosted_trees.BINS - 1)) > F.col("before"))).select("kind", "feature", "value").collect()
    out = {k: [[] for _ in FEATURES] for k in kinds}
    for r in ends:
        out[r["kind"]][r["feature"]].append(r["value"])
    return {k: [np.array(sorted(e)) for e in own_edges] for k, own_edges in out.items()}


def _example_maker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def table(rows: list[tuple]) -> pa.RecordBatch:
        kind, fold, label, x = zip(*rows)
        flat = pa.array(np.array(x, float).ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(FEATURES), pa.int32()), flat)
        return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array([f == HELD_FOLD for f in fold]), pa.array(label, pa.int32()), lists], ["kind", "held", "label", "x"])

    rows: list[tuple] = []
    for batch in batches:
        for text in batch.column(0):
            rows += examples(text.as_py() or "", FOLDS)
            if len(rows) >= 4096:
                yield from (table(rows[at:at + 4096]) for at in range(0, len(rows), 4096))
                rows = []
    if rows:
        yield table(rows)


def _binner(edges: dict[int, list[np.ndarray]]):
    """(kind, held, label, x) -> cells of one example each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, label = batch.column(0).to_numpy(), batch.column(2).cast(pa.int64())
            x = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            for k, own in edges.items():
                rows = np.flatnonzero(kind == k)
                bins = boosted_trees.bin_rows(x[rows], own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kind[rows], pa.int32()), batch.column(1).take(pa.array(rows)), pa.array([r.tobytes() for r in bins], pa.binary()),
                     pa.array(np.ones(len(rows), np.int64)), label.take(pa.array(rows))], ["kind", "held", "bins", "n", "positives"])
    return run


def _cells(batches) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per kind of a batch of cells: kind, bins, examples, right ones."""
    for batch in batches:
        kind, n, positives = (batch.column(i).to_numpy() for i in (0, 3, 4))
        bins = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, len(FEATURES))
        for k in np.unique(kind).tolist():
            rows = kind == k
            yield k, bins[rows], n[rows].astype(float), positives[rows].astype(float)


def _add_up(cells: DataFrame, growing: dict[int, boosted_trees.Growing], level: int) -> dict[int, np.ndarray]:
    """``boosted_trees.sums`` of all cells, as a Spark job."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for one in _cells(batches):
            for k, found in boosted_trees.sums([one], growing, level).items():
                total[k] = total.get(k, 0) + found
        for k, found in total.items():
            g, h = found.reshape(2, -1).astype(np.int64)
            at = np.flatnonzero(h | g)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k), pa.int32()), pa.array(at, pa.int32()), pa.array(g[at]), pa.array(h[at])], ["kind", "at", "g", "h"])

    rows = cells.mapInArrow(run, "kind int, at int, g long, h long").groupBy("kind", "at").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
    kind, at, g, h = (rows.column(c).to_numpy() for c in ("kind", "at", "g", "h"))
    out = {}
    for k, state in growing.items():
        total = np.zeros((2, state.features * boosted_trees.BINS << level))
        own = kind == k
        total[0, at[own]], total[1, at[own]] = g[own], h[own]
        out[k] = total.reshape(2, state.features, 1 << level, boosted_trees.BINS)
    return out


def _score_counter(edges: dict[int, list[np.ndarray]], trees: dict[int, dict]):
    """Cells -> (kind, step of the score, examples, right ones)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, bins, n, positives in _cells(batches):
            # any value of a bin stands for it
            x = np.stack([np.append(e, e[-1] + 1 if len(e) else 0)[bins[:, f]] for f, e in enumerate(edges[k])], 1)
            step = np.floor(np.clip(boosted_trees.score(trees[k], x), -SCORE_BOUND, SCORE_BOUND) * SCORE_STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), k), pa.int32()), pa.array(step), pa.array(n.astype(np.int64)), pa.array(positives.astype(np.int64))],
                                             ["kind", "step", "n", "positives"])
    return run


def find_pii(docs: DataFrame, models: dict, id_col: str = "doc_id", text_col: str = "text", redact: bool = False) -> DataFrame:
    """doc_id, spans (kind, start, end in code points, base, score; ascending),
    and with ``redact`` the text with every span replaced by its kind in <>.

    Base spans all stay, with score 1. A candidate is added if its calibrated
    score reaches its kind's threshold and it touches no base span nor an added
    one of a higher score (then: longer, then first). A null or empty text has
    no spans. Rows stay as they are; other columns are not read. One narrow pass.
    """
    ship(per_process.__module__, boosted_trees.__name__, base_spans.__module__, __name__)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    model = docs.sparkSession.sparkContext.broadcast(models)
    out = rows.mapInArrow(_finder(model, redact), f"id {id_type}, spans {_SPANS}, redacted string")
    return out.select(F.col("id").alias("doc_id"), "spans", *(["redacted"] if redact else []))


def added_spans(text: str, base: list[tuple[int, int, int]], models: dict) -> list[tuple[int, int, int, float]]:
    """(start, kind, end, score) of the candidates that are added."""
    free = apart(candidates(text), base)
    scored = []
    for k, model in models.items():
        own = [c for c in free if c[1] == k]
        if own and model["threshold"] <= 1:
            x = np.array([features(text, *c) for c in own], float)
            p = boosted_trees.probability(model["steps"], boosted_trees.score(model["trees"], x))
            scored += [(-float(s), c[0] - c[2], *c) for s, c in zip(p, own) if s >= model["threshold"]]
    taken, used = [], set()
    for s, _, start, kind, end in sorted(scored):
        if used.isdisjoint(range(start, end)):
            used.update(range(start, end))
            taken.append((start, kind, end, -s))
    return taken


def _finder(model, redact: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())]))
        for batch in batches:
            found, texts = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                spans = sorted([(*b, True, 1.0) for b in base] + [(s, k, e, False, p) for s, k, e, p in added_spans(text, base, model.value)])
                found.append([{"kind": KINDS[k], "start": s, "end": e, "base": b, "score": p} for s, k, e, b, p in spans])
                texts.append(_redacted(text, spans) if redact else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind_type), pa.array(texts, pa.string())], ["id", "spans", "redacted"])
    return run


def _redacted(text: str, spans: list[tuple]) -> str:
    out, at = [], 0
    for start, kind, end, *_ in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])
