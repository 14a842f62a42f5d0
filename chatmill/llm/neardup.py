"""Near-duplicate documents by min-max hashing (Ji et al.).

Every permutation gives two values of a signature, its minimum and its maximum
over the document's shingles, so half the hash evaluations suffice. A band is
the minima and maxima of two permutations. Documents with equal sets form one
class, whose representative alone goes on. Representatives that share a band
are compared on their full sets.

A bucket's members are compared with its centre, the smallest member. Where a
bucket then still holds several components, its members go on to an exact search:

* the shingles of these members are counted, and ordered by that count. A pair
  that is alike shares its rarest common shingle at a place so far to the front
  of both orders that the rest can still hold the overlap they need (prefix and
  position filter). What only one member has is not shared, but takes a place;
* the smaller one of a pair files under its first shingles, and its size; the
  larger one looks under its own, at those sizes that its rest allows. So a
  member whose own part is too large for any link meets nobody.

There, filed members are centres in turn, 1, then 8, then 64 of a bucket, each
compared with the members that are not linked to it yet, until all have been
one or the bucket is one component; where few pairs are left for the members
(``FEW_PAIRS``), all are compared at once. No pair that shares a band is left
out. Two sets of Jaccard similarity 0.8 share none of the 28 bands with a
chance of about 4e-7.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingle_sets
from .common import NULL_ID, discard, ship, staged
from .components import components

BANDS, PERMS_PER_BAND = 28, 2
#: Pairs a member, on average, up to which open buckets are compared at once.
FEW_PAIRS = 4


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document.

    Linked are documents whose sets of ``size``-word shingles have at least
    ``percent`` hundredths of their union in common. A component's id is its
    smallest doc_id; one row of that id is kept. Documents without words (null,
    empty) are linked with nothing and kept. Every row is judged by its own text:
    rows that share an id, or have none, are not linked by that. A null id is
    the smallest id. Ids are cast to long, of which the least stands for a null
    one. Extra columns are not read. Staged tables cut the lineage.
    """
    return _judged(docs, size, percent, id_col, text_col).drop("h")


def _judged(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``near_duplicates`` with ``h``, the hash of the text."""
    if not 0 < percent <= 100 or size < 1:
        raise ValueError("percent lies in (0, 100], size is 1 or more")
    ship(shingle_sets.__name__)
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    sig, sig_path = staged(rows.mapInArrow(
        shingle_sets.signer(size, BANDS, PERMS_PER_BAND), "id long, n_shingles long, digest binary, bands array<long>, h long").withColumn("row", F.monotonically_increasing_id()), "signatures")
    classes, class_path = staged(sig.where("n_shingles > 0").groupBy("digest").agg(
        F.min(F.struct("id", "h", "row")).alias("first"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "classes")
    # a class is the node of its smallest id, or of its digest's hash where classes share that id or it is null
    clash, clash_path = staged(classes.groupBy(F.col("first.id").alias("clash")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("clash"), "clashes")
    classes = classes.join(clash, F.col("first.id") == F.col("clash"), "left").withColumn(
        "node", F.when(F.col("clash").isNotNull() | (F.col("first.id") == NULL_ID), F.xxhash64("digest")).otherwise(F.col("first.id"))).drop("clash")
    sizes = classes.groupBy("node").agg(F.max("n").alias("most"), F.min("n").alias("least"))

    members = classes.select("node", F.explode("bands").alias("key")).distinct()
    shared = members.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
    members, members_path = staged(members.join(shared, "key"), "members")
    heads = classes.select("node", "first.id", "first.h").join(members.select("node").distinct(), "node")
    texts, texts_path = staged(rows.join(heads, ["id", "h"]).groupBy("id", "h", "node").agg(F.first("text").alias("text")).select("node", "text"), "texts")
    paths = [sig_path, class_path, clash_path, texts_path]
    compared = spark.createDataFrame([], "a long, b long")
    labels, labels_path = spark.createDataFrame([], "node long, label long"), None

    def labelled(df: DataFrame, node: str, name: str) -> DataFrame:
        known = labels.select(F.col("node").alias(node), F.col("label").alias(name))
        return df.join(known, node, "left").withColumn(name, F.coalesce(F.col(name), F.col(node)))

    def compare(pairs: DataFrame) -> None:
        """Compares the pairs (a, b) and brings compared and labels up to date."""
        nonlocal compared, labels, labels_path
        pairs, path = staged(pairs.select("a", "b"), "pairs")
        paths.append(path)
        a, b = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        both = pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b")
        found, path = staged(both.mapInArrow(shingle_sets.comparer(size, percent), "a long, b long"), "links")
        paths.append(path)
        compared = compared.union(pairs)
        if found.isEmpty():
            return
        # links between components so far; a component of these takes its smallest label
        joined, path = components(labelled(labelled(found, "a", "la"), "b", "lb").select(F.col("la").alias("a"), F.col("lb").alias("b")))
        paths.append(path)
        joined = joined.select(F.col("node").alias("was"), F.col("label").alias("to"))
        known = labels.join(joined, F.col("label") == F.col("was"), "left").select("node", F.coalesce("to", "label").alias("label"))
        newer = joined.join(labels.select("node"), F.col("was") == F.col("node"), "left_anti").select(F.col("was").alias("node"), F.col("to").alias("label"))
        if labels_path:
            paths.append(labels_path)
        labels, labels_path = staged(known.unionByName(newer), "labels")

    def open_pairs(pairs: DataFrame) -> DataFrame:
        """Those not compared yet, of sizes that allow a link, in different components."""
        s = lambda c: sizes.select(F.col("node").alias(c), F.col("most").alias(f"most_{c}"), F.col("least").alias(f"least_{c}"))
        fits = ((F.col("most_a") * 100 >= F.col("least_b") * percent) & (F.col("most_b") * 100 >= F.col("least_a") * percent))
        left = pairs.join(compared, ["a", "b"], "left_anti").join(s("a"), "a").join(s("b"), "b").where(fits)
        return labelled(labelled(left, "a", "la"), "b", "lb").where("la != lb").select("a", "b", "shared")

    def still_open(rows: DataFrame) -> DataFrame:
        """The rows whose key holds several components, and one that is filed."""
        known = labelled(rows, "node", "label")
        mixed = known.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.max("filed").alias("any")).where("lo < hi and any").select("key")
        return known.join(mixed, "key").select(*rows.columns)

    def finer(rows: DataFrame) -> DataFrame:
        """(key, node, filed) of the shingles that a link of the nodes of ``rows`` would begin with."""
        some = texts.join(rows.select("node").distinct(), "node")
        grams, path = staged(some.mapInArrow(shingle_sets.gram_lister(size), "node long, size long, shingle long"), "grams")
        paths.append(path)
        shared = grams.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        listed = grams.join(shared, "shingle").groupBy("node", "size").agg(F.collect_list(F.struct("n", "shingle")).alias("shared"))
        return listed.mapInArrow(shingle_sets.prefixer(percent), "key long, node long, filed boolean").groupBy("key", "node").agg(F.max("filed").alias("filed"))

    # first, each member with the one centre that most of its bands share, then with its other centres
    centres = members.groupBy("key").agg(F.min("node").alias("c"))
    pairs = members.join(centres, "key").where("node != c").groupBy(F.col("c").alias("a"), F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("shared"))
    pairs, pairs_path = staged(open_pairs(pairs), "candidates")
    best = pairs.groupBy("b").agg(F.max(F.struct("shared", -F.col("a"))).alias("m"))
    compare(best.select((-F.col("m.col2")).alias("a"), "b"))
    compare(open_pairs(pairs))
    left = members.join(centres.withColumnRenamed("c", "node"), ["key", "node"], "left_anti").withColumn("filed", F.lit(True))
    opened, newer = staged(still_open(left), "members")
    discard(spark, members_path, pairs_path)
    members, members_path = opened, newer
    if not members.isEmpty():
        opened, newer = staged(still_open(finer(members)), "members")
        discard(spark, members_path)
        members, members_path = opened, newer
    turn = 0
    while not members.isEmpty():
        by_label = labelled(members, "node", "label").groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.count_if("filed").alias("f"))
        by_key = by_label.groupBy("key").agg(F.sum("n").alias("n"), F.sum("f").alias("f"), F.sum(F.col("n") * F.col("f")).alias("within"))
        left = by_key.agg(F.sum(F.col("n") * F.col("f") - F.col("within")).alias("pairs"), F.sum("n").alias("members")).first()
        if left["pairs"] <= FEW_PAIRS * left["members"]:
            centres = members.where("filed").select("key", F.col("node").alias("c"))
        else:
            part = F.pmod(F.xxhash64("key", "node", F.lit(turn)), F.lit(8 ** min(turn, 20)))
            centres = members.where("filed").groupBy("key", part.alias("part")).agg(F.min("node").alias("c")).select("key", "c")
        apart = labelled(members, "node", "own").alias("m").join(labelled(centres, "c", "other").alias("o"), (F.col("m.key") == F.col("o.key")) & (F.col("own") != F.col("other")))
        pairs = apart.groupBy(F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b")).agg(F.count(F.lit(1)).alias("shared"))
        compare(open_pairs(pairs))
        opened, newer = staged(still_open(members.join(centres.withColumnRenamed("c", "node"), ["key", "node"], "left_anti")), "members")
        discard(spark, members_path)
        members, members_path, turn = opened, newer, turn + 1

    grouped = labelled(classes.select("digest", "node", "first"), "node", "label")
    tops = grouped.join(grouped.groupBy("label").agg(F.min("first").alias("top")), "label").select("digest", "top")
    out = sig.select("id", "n_shingles", "digest", "h", "row").join(tops, "digest", "left")
    shown = lambda c: F.when(c != NULL_ID, c)
    out, _ = staged(out.select(shown(F.col("id")).alias("doc_id"), "n_shingles", shown(F.coalesce("top.id", "id")).alias("component_id"),
                               F.coalesce(F.col("top.row") == F.col("row"), F.lit(True)).alias("kept"), "h"), "neardup")
    discard(spark, members_path, *paths, *([labels_path] if labels_path else []))
    return out


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The documents, all columns, of which one a component stays. Rows are
    told apart by id and text; of rows equal in both, any one stays."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    rows = _judged(docs, **options).groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("kept")).where("kept < n")
    some, _ = staged(rows.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), "kept"), "judged")
    same = lambda x: docs[id_col].eqNullSafe(x["_id"]) & (F.xxhash64(docs[text_col]) == x["_h"])
    one = some.where("kept > 0")
    return docs.join(some, same(some), "left_anti").union(docs.join(one, same(one), "left_semi").dropDuplicates([id_col, text_col]))
