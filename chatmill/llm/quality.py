"""Quality by nearest-neighbour voting in a latent-semantic space.

Every document becomes a tf-idf vector of word shapes, repetition rates, words
and pairs of words, projected on the leading singular vectors of labelled documents. The labelled
vectors are broadcast; every document meets all of them in blocked cosine
products, and its nearest ones vote, weighted by similarity.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import quality_terms
from .common import ship, staged
from .shingle_sets import mixed
from .toxicity import bounded_sample, fold

#: Labelled vectors at most, of lowest id hash (64 floats each: 2 MB), and their rank.
MAX_LABELLED, RANK = 8_192, 64
NEIGHBOURS, POWER = 15, 8.0
FOLDS, HELD_FOLD, THRESHOLD = 4, 2, 0.7


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(doc_id, score) of every whole text; labels are those outside the
    held-out fold.

    Document frequencies cover all documents. A null text is empty; an empty
    one is scored by its (few) terms. Null labels are left out; without labels
    every score is 1/2. Rows that share an id are each scored; as labelled
    rows each counts. Other columns are not read.
    """
    ship(quality_terms.__name__, mixed.__module__)
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    terms, _ = staged(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(quality_terms.extractor, f"id {id_type}, terms binary, values binary"), "terms")
    n = terms.count()
    seen = terms.select("terms").mapInArrow(quality_terms.frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()   # one row a term
    idf = np.ones(quality_terms.DIMS, np.float32)
    for r in seen:
        idf[r["term"]] = np.log((n + 1) / (r["n"] + 1)) + 1
    wanted = labels.select(F.col("doc_id").alias("id"), F.col(label_col).cast("double").alias("label")).where(F.col("label").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_FOLD))
    drawn = F.broadcast(bounded_sample(wanted, MAX_LABELLED))
    rows = bounded_sample(terms.join(drawn, "id"), MAX_LABELLED).collect()
    x = quality_terms.matrix([r["terms"] for r in rows], [r["values"] for r in rows], idf)
    axes = quality_terms.latent_axes(x, RANK)
    model = spark.sparkContext.broadcast((idf, axes, quality_terms.unit(x @ axes), np.array([r["label"] for r in rows], np.float64)))
    scored = terms.mapInArrow(quality_terms.voter(model, NEIGHBOURS, POWER), f"id {id_type}, score double")
    return scored.withColumnRenamed("id", "doc_id")
