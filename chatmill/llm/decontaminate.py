"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are partitioned by the size of their shingle set. An item's MinHash
sketch holds its k smallest shingle hashes, k set by its partition's upper
size u as floor((1 - t) u) + 1. A document that contains a share t of the item
lacks at most floor((1 - t) u) of its shingles, hence holds one of the sketch
at least, however long the document is: the search misses nothing. Documents
are sketched to the hashes not above the largest sketch value and meet the
sketches in an equi-join; exact containment of the shingles decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import check_threshold, discard, staged, text_of

#: Sketch values that are broadcast at most (16 bytes each); above, a shuffle join.
MAX_BROADCAST_SKETCH = 1_000_000


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def shingles(words: Column, size: int) -> Column:
    """Strings of ``size`` words each; none if there are fewer words."""
    return F.when(F.size(words) >= size, F.transform(
        F.sequence(F.lit(1), F.size(words) - (size - 1)), lambda i: F.array_join(F.slice(words, i, size), " "))
    ).otherwise(F.array().cast("array<string>"))


def shingle_hashes(hashes: Column, size: int) -> Column:
    """Hashes of the same shingles, from the words' hashes."""
    return F.when(F.size(hashes) >= size, F.transform(
        F.sequence(F.lit(0), F.size(hashes) - size), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(size)]))
    ).otherwise(F.array().cast("array<bigint>"))


def item_sketches(items: DataFrame, threshold: float, size: int) -> DataFrame:
    """item_id, width (words a shingle), grams (distinct), n_item, sketch."""
    words = items.select("item_id", words_of(text_of("text")).alias("words")).where(F.size("words") > 0)
    words = words.withColumn("width", F.least(F.size("words"), F.lit(size))).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    by_width = lambda f, col: F.coalesce(*[F.when(F.col("width") == w, f(F.col(col), w)) for w in range(1, size + 1)])
    sets = words.select("item_id", "width", F.array_distinct(by_width(shingles, "words")).alias("grams"),
                        F.sort_array(F.array_distinct(by_width(shingle_hashes, "hashes"))).alias("values"))
    upper = F.pow(F.lit(2.0), F.floor(F.log2(F.size("values"))) + 1) - 1      # of the size partition
    k = F.floor(F.round((1 - threshold) * upper, 9)) + 1
    return sets.select("item_id", "width", "grams", F.size("grams").alias("n_item"),
                       F.slice("values", 1, F.least(k, F.size("values")).cast("int")).alias("sketch"))


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.8, size: int = 5,
               id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Pairs (doc_id, item_id, n_shared, n_item, containment) of documents that
    contain a share ``threshold`` of an item's distinct shingles or more.

    Shingles are ``size`` words; an item of fewer words is one shingle of its
    own length. Items without words match nothing, as do null and empty texts.
    Rows that share an id count as one document or item: the best pair stays.
    A null id is an id. Extra columns are not read. Empty tables give no pairs.
    """
    check_threshold(threshold)
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    sketches, items_path = staged(item_sketches(
        items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")), threshold, size), "sketches")
    # one row a shingle width, at most `size` rows
    widths = {r["width"]: r["top"] for r in sketches.select("width", F.element_at("sketch", -1).alias("top")).groupBy("width").agg(F.max("top").alias("top")).collect()}
    values = sketches.select("width", "item_id", F.explode("sketch").alias("value"))
    if values.count() <= MAX_BROADCAST_SKETCH:
        values = F.broadcast(values)
    hashed = docs.select("doc_id", F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes"))

    def sketch_of(width: int, top: int) -> Column:
        low = F.array_distinct(F.filter(shingle_hashes(F.col("hashes"), width), lambda h: h <= top))
        return F.transform(low, lambda h: F.struct(F.lit(width).alias("width"), h.alias("value")))

    kept = [sketch_of(*x) for x in sorted(widths.items())]
    none = F.array().cast("array<struct<width:int,value:bigint>>")
    probes = hashed.select("doc_id", F.inline(F.concat(none, *kept)))
    pairs, pairs_path = staged(probes.join(values, ["width", "value"]).groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("hits")), "leak-candidates")

    c, s, d = pairs.alias("c"), sketches.alias("s"), docs.alias("d")
    both = c.join(s, F.col("c.item_id").eqNullSafe(F.col("s.item_id"))).select("c.doc_id", "c.item_id", "width", "grams", "n_item")
    both = both.alias("b").join(d, F.col("b.doc_id").eqNullSafe(F.col("d.doc_id"))).select("b.*", words_of(F.col("d.text")).alias("words"))
    own = F.coalesce(*[F.when(F.col("width") == w, shingles(F.col("words"), w)) for w in range(1, size + 1)])
    exact = both.select("doc_id", "item_id", F.size(F.array_intersect("grams", own)).cast("long").alias("n_shared"), F.col("n_item").cast("long").alias("n_item"))
    exact = exact.withColumn("containment", F.col("n_shared") / F.col("n_item"))
    best = exact.groupBy("doc_id", "item_id").agg(F.max(F.struct("containment", "n_shared", "n_item")).alias("m")).select("doc_id", "item_id", "m.n_shared", "m.n_item", "m.containment")
    best = best.where(F.col("containment") >= threshold)   # after the grouping: pushed below it, the filter would compute the words anew for each shingle
    out, _ = staged(best, "leaks")
    discard(spark, items_path, pairs_path)
    return out


def drop_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents, all columns, that contain no item; see ``find_leaks``.
    Every row is judged by its own text, also where ids repeat or are null."""
    id_col, text_col = options.pop("id_col", "doc_id"), options.pop("text_col", "text")
    keyed = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h")).alias("doc_id"), F.col(text_col).alias("text"))
    leaked = find_leaks(keyed, items, **options).select(F.col("doc_id.id").alias("_leaked"), F.col("doc_id.h").alias("_h")).distinct()
    return docs.join(leaked, docs[id_col].eqNullSafe(leaked["_leaked"]) & (F.xxhash64(docs[text_col]) == leaked["_h"]), "left_anti")


#: DuckDB: every item's containment in every document, by exact shingles.
SQL = r"""
WITH w AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM benchmark),
 i AS (SELECT item_id, least(len(ws), 5) AS width, ws FROM w WHERE len(ws) > 0),
 ig AS (SELECT DISTINCT item_id, width, array_to_string(ws[p : p + width - 1], ' ') AS gram
        FROM (SELECT item_id, width, ws, unnest(range(1, len(ws) - width + 2)) AS p FROM i)),
 n AS (SELECT item_id, width, count(*) AS n_item FROM ig GROUP BY ALL),
 d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM documents),
 dg AS (SELECT DISTINCT doc_id, width, array_to_string(ws[p : p + width - 1], ' ') AS gram
        FROM (SELECT doc_id, width, ws, unnest(range(1, len(ws) - width + 2)) AS p FROM d, (SELECT DISTINCT width FROM n))),
 m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM dg JOIN ig USING (width, gram) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM m JOIN n USING (item_id) WHERE n_shared / n_item >= 0.8
"""
