"""Document fingerprints: Merkle trees over sections, paragraphs and clauses.

The leaves are the text cut, without loss, into clauses of at most eight words
that end at a sentence's or a line's end. A line is a paragraph, a blank line
ends a section. A node is the hash of its children's hashes; the root hashes
the sections'. Equal roots mean equal texts, and the branches that differ tell
where two texts do.

A fingerprint is one string:
``root:section(paragraph=leaf.leaf,paragraph=leaf);section(...)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NULL_ID, bucket_of, range_bounds, text_of

_CLAUSE = r"(?:[^\S\n]*+\S++(?<![.!?])){0,7}[^\S\n]*+\S++[^\S\n]*+\n*+|\s++"
#: Hex digits kept of a leaf and of an inner node.
LEAF, NODE = 10, 8


def clauses(text: Column) -> Column:
    """The leaves; concatenated, they are the text."""
    return F.regexp_extract_all(text, F.lit(_CLAUSE), F.lit(0))


def with_fingerprint(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Adds the fingerprint of ``text`` as column ``name``; a null text is empty."""
    def leaf(x: Column) -> Column:
        ends_section = x.contains("\n\n") | (F.translate(x, " \t\r\n", "") == "")
        return F.concat(F.md5(x), F.when(ends_section, "/").when(x.endswith("\n"), ",").otherwise(""))

    def nonempty(parts: Column) -> Column:
        return F.filter(parts, lambda p: p != "")

    def paragraph(p: Column) -> Column:
        leaves = F.regexp_replace(p, f"(.{{{LEAF}}}).{{{32 - LEAF}}}(?=.)", "$1.")
        return F.concat(F.substring(F.md5(p), 1, NODE), F.lit("="), F.regexp_replace(leaves, f"(.{{{LEAF}}}).{{{32 - LEAF}}}$", "$1"))

    def section(s: Column) -> Column:
        parts = nonempty(F.split(s, ","))
        return F.struct(F.md5(F.array_join(F.transform(parts, lambda p: F.md5(p)), "")).alias("node"),
                        F.array_join(F.transform(parts, paragraph), ",").alias("paragraphs"))

    marks, tree = f"_{name}_marks", f"_{name}_tree"
    out = df.withColumn(marks, F.array_join(F.transform(clauses(F.coalesce(text, F.lit(""))), leaf), ""))
    out = out.withColumn(tree, F.transform(nonempty(F.split(marks, "/")), section))
    root = F.sha2(F.array_join(F.transform(F.col(tree), lambda s: s["node"]), ""), 256)
    shown = F.array_join(F.transform(F.col(tree), lambda s: F.concat(F.substring(s["node"], 1, NODE), F.lit("("), s["paragraphs"], F.lit(")"))), ";")
    return out.withColumn(name, F.concat(root, F.lit(":"), shown)).drop(marks, tree)


def leaves_of(fingerprint: Column) -> Column:
    """The distinct leaf hashes of a fingerprint."""
    return F.array_distinct(F.regexp_extract_all(fingerprint, F.lit(f"[=.]([0-9a-f]{{{LEAF}}})"), F.lit(1)))


def likeness(a: Column, b: Column, leaves_a: Column, leaves_b: Column) -> Column:
    """Dice coefficient of the leaves of two fingerprints; 1 for equal ones."""
    both = F.size(leaves_a) + F.size(leaves_b)
    return F.when(a == b, F.lit(1.0)).when(both == 0, F.lit(0.0)).otherwise(
        F.lit(2.0) * F.size(F.array_intersect(leaves_a, leaves_b)) / both)


def changed_paragraphs(a: Column, b: Column) -> Column:
    """Paragraph nodes of ``a`` that ``b`` lacks: where an edit took place. The
    tree is descended where it differs: nothing below equal roots, nor below
    sections that both have, is looked at."""
    sections = lambda f: F.regexp_extract_all(f, F.lit(f"[0-9a-f]{{{NODE}}}\\([^)]*\\)"), F.lit(0))
    nodes = lambda some: F.flatten(F.transform(some, lambda s: F.regexp_extract_all(s, F.lit(f"([0-9a-f]{{{NODE}}})="), F.lit(1))))
    below = F.array_except(nodes(F.array_except(sections(a), sections(b))), nodes(sections(b)))
    return F.when(F.substring_index(a, ":", 1) == F.substring_index(b, ":", 1), F.array().cast("array<string>")).otherwise(below)


def with_next(docs: DataFrame, rows_per_bucket: int = 1_000) -> DataFrame:
    """Adds next_text and next_fp of the document that follows in descending
    (doc_id, text) order, the last one's being the first.

    ``docs``: doc_id, text and fp are computed after one exchange, by ranges of
    doc_id. The bounds are ids of the table, so the largest row of a range is
    known by sight: it goes to the following range too, as the neighbour of
    that range's first row. No window covers more than one range.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(NULL_ID))
    bounds = range_bounds(docs.select(key.alias("k")), F.col("k"), rows_per_bucket)
    upper = F.get(F.split(F.lit(",".join(map(str, bounds or [0]))), ",").cast("array<bigint>"), F.col("_own"))
    own = F.struct(F.col("_own").alias("g"), F.lit(1).alias("real"))
    guest = F.struct(F.pmod(F.col("_own") + 1, F.lit(max(1, len(bounds)))).alias("g"), F.lit(0).alias("real"))
    spread = (docs.withColumn("_k", key).withColumn("_own", bucket_of(F.col("_k"), bounds))
              .withColumn("_at", F.explode(F.when(upper == F.col("_k"), F.array(own, guest)).otherwise(F.array(own))))
              .select("doc_id", "text", "_k", F.col("_at.g").alias("_g"), F.col("_at.real").alias("_real"))
              .repartition("_g"))
    order = Window.partitionBy("_g").orderBy("_real", "_k", "text")
    return (with_fingerprint(spread, F.col("text"), "fingerprint")
            .withColumn("next_text", F.lag("text").over(order)).withColumn("next_fp", F.lag("fingerprint").over(order))
            .where("_real = 1").drop("_k", "_g", "_real"))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, whose second
    half is the next document's beginning, and how alike they are.

    Null and empty texts have the fingerprint of no leaves. A null id comes
    last in descending order; rows with one id follow their texts' order; a
    single row is its own next. Columns other than the two are not read.
    """
    rows = with_next(docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn(
        "edited", F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")),
                           F.substring(F.col("next_text"), F.lit(1), half)))
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited"), 256)).drop("text", "next_text")
    rows = with_fingerprint(rows, F.col("edited"), "edited_fingerprint").drop("edited")
    rows = rows.withColumns({"_own": leaves_of(F.col("fingerprint")), "_edit": leaves_of(F.col("edited_fingerprint")), "_next": leaves_of(F.col("next_fp"))})
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), F.col("_own"), F.col("_edit")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fp"), F.col("_own"), F.col("_next")).alias("near_next"))
