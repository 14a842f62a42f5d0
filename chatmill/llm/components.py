"""Connected components of a link table, by alternating large and small stars
(Kiveris et al.): every step is a grouped minimum and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: hang every larger neighbour of a node on the smallest of its
    neighbourhood. Small star: hang the smaller ones and the node itself."""
    if large:
        around = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        hung = around.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        hung = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    return hung.where("u != v").distinct()


def components(links: DataFrame) -> tuple[DataFrame, str]:
    """(node, label) of every node of the links (a, b), the label being the
    smallest node of its component; and the path where they are staged."""
    spark = links.sparkSession
    edges, path = staged(links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u != v").distinct(), "edges")
    mark = None
    while True:
        edges, newer = staged(_star(_star(edges, large=True), large=False), "edges")
        discard(spark, path)
        path = newer
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40))).first()
        if now == mark:
            break
        mark = now
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    out, labels_path = staged(labels.union(labels.select(F.col("label").alias("node"), "label").distinct()), "labels")
    discard(spark, path)
    return out, labels_path
