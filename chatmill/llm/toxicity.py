"""Toxicity: a logistic classifier with a counterfactual penalty.

Features are words and their beginnings and endings. Identity terms of the
labelled texts are swapped, one after the other, for others of their group; the
loss penalises what that changes of the score, so a neutral mention of a group
does not raise it. A model tells how many of its rows had a term to swap.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import toxic_words
from .common import ship

#: Labelled rows that the classifier is fitted to at most, of lowest id hash; and features.
MAX_TRAIN_ROWS, MAX_FEATURES = 20_000, 2_000
#: Log-likelihood ratio above which a feature is taken.
LEAST_EVIDENCE = 15.0
FOLDS, HELD_FOLD = 5, 0
THRESHOLD = 0.5


@dataclass(frozen=True)
class Model:
    features: list[str]
    weights: list[float]
    bias: float
    #: Labelled rows that the model was fitted to, and those of them with a counterfactual.
    rows: int = 0
    swapped_rows: int = 0


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as 'null'."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("null")).cast("binary")) % folds


def bounded_sample(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, of lowest id hash; all if there are no more."""
    return rows.orderBy(F.xxhash64("id", F.lit(2)), "id").limit(most)


def train(texts: DataFrame, penalty: float = 10.0, ridge: float = 1e-4, steps: int = 200, max_rows: int = MAX_TRAIN_ROWS,
          identity_terms=toxic_words.IDENTITY_TERMS) -> Model:
    """A model from rows (id, text, label). Null labels are left out; a null
    text has no words. Without rows, the model scores 1/4. ``identity_terms``:
    lines of lower-case words that stand for one another."""
    swap = toxic_words.swaps(identity_terms)
    ship(toxic_words.__name__)
    spark = texts.sparkSession
    rows = texts.where("label IS NOT NULL").select("id", "text", F.col("label").cast("long").alias("label"))
    if rows.count() > max_rows:                     # ``fit_to`` has drawn by id before
        rows = bounded_sample(rows, max_rows)
    sample = rows.select("text", "label").persist()
    total = sample.agg(F.coalesce(F.sum("label"), F.lit(0)).alias("ones"), F.count(F.lit(1)).alias("n")).first()
    tally = sample.mapInArrow(toxic_words.tally, "feature string, ones long, zeros long").groupBy("feature").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    share = F.lit(total["ones"] / max(1, total["n"]))
    excess = lambda c, p: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / ((F.col("ones") + F.col("zeros")) * p))).otherwise(0.0)
    best = (tally.where("ones + zeros >= 3").withColumn("g", 2 * (excess("ones", share) + excess("zeros", 1 - share)))   # log-likelihood ratio
            .where(F.col("g") > LEAST_EVIDENCE).orderBy(F.col("g").desc(), "feature").limit(MAX_FEATURES))
    features = sorted({r["feature"] for r in best.select("feature").collect()} | set(swap))
    shared = spark.sparkContext.broadcast(features)
    rows = sample.mapInArrow(toxic_words.vectors(shared, swap), "label long, own array<int>, others array<array<int>>").collect()   # at most max_rows
    sample.unpersist()
    own, others = [np.array(r["own"], np.int64) for r in rows], [[np.array(o, np.int64) for o in r["others"]] for r in rows]
    weights, bias = toxic_words.fit(own, others, np.array([r["label"] for r in rows], np.float64), len(features), penalty, ridge, steps)
    return Model(features, weights.tolist(), bias, len(rows), sum(map(bool, others)))


def score_of(spark: SparkSession, text: Column, model: Model) -> Column:
    """The score of a text, in (0, 1). Empty and null texts get the bias's."""
    ship(toxic_words.__name__)
    shared = spark.sparkContext.broadcast((model.features, model.weights, model.bias))
    return F.pandas_udf(toxic_words.scorer(shared), "double")(text)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every whole text. Rows stay as they are; other columns
    are not read."""
    return docs.select(F.col(id_col).alias("doc_id"), score_of(docs.sparkSession, F.col(text_col), model).alias("score"))


def fit_to(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **options) -> Model:
    """The model for ``labels.toxic``, without the held-out fold. The sample is
    drawn by id before any text is read, so only its texts are moved."""
    wanted = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where(F.col("label").isNotNull() & (fold(F.col(id_col), FOLDS) != HELD_FOLD))
    drawn = bounded_sample(wanted, options.get("max_rows", MAX_TRAIN_ROWS))
    return train(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(drawn), "id"), **options)


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents, all columns, that score below the threshold: one narrow pass."""
    return docs.where(score_of(docs.sparkSession, F.col(text_col), model) < THRESHOLD)
