"""Adapter: stage the driver's tables as the three QA sources.

This is not a reference feature; it turns the given tables into rows of the
reference's source shapes so every operator runs on data that grows with
them:

* question = a ``user`` turn of ``conversations``; raw rows are user turns
  in source order, which is what the per-source caps count;
* answer   = the ``assistant`` turn at ``turn + 1`` of the same conversation
  (none -> an empty answer list / unanswerable);
* context  = ``documents.text`` with ``doc_id = conv_id``;
* the evidence source wraps document text, page HTML and page URL into the
  polymorphic JSON fields, with a shape chosen by ``pmod(conv_id, 6)`` so
  every context tier and the placeholder are reached (a shape selector,
  not a filter: all rows are kept).

Joins are equi-joins on (conv_id, turn), which one conversation cannot skew,
and on (conv_id, salt): a hot conversation is salted (``operators.skew``)
rather than pulled into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmill.operators.ordinal import SRC_FILE, SRC_ROW, cap_condition, prefix_cap, scan_with_position
from chatmill.operators.sieve import key_bitmap, sift
from chatmill.operators.skew import HOT_ROWS, SALT, hot_keys, salt_big, salt_small

SOURCES = ("squad", "squad_v2", "trivia_qa")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def rec_key(source: str) -> Column:
    return F.concat_ws(":", F.lit(source), F.col("conv_id").cast("string"), F.col("turn").cast("string"))


def cap_column(cap: int) -> str:
    return f"_within_{cap}"


def user_turns(spark: SparkSession, sf_dir: str, cap: int | None = None, caps: tuple[int, ...] = ()) -> DataFrame:
    """Raw QA rows (user turns) in source order, first ``cap`` only (L1);
    ``caps`` adds a column for each that says whether a row is within it."""
    if cap is None and not caps:              # no position needed: plain scan
        return read_table(spark, sf_dir, "conversations").where(F.col("role") == "user").select(
            "conv_id", "turn", F.col("text").alias("question"))
    conv = scan_with_position(spark, table_path(sf_dir, "conversations"))
    users = conv.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("question"), SRC_FILE, SRC_ROW)
    kept = prefix_cap(users, cap)
    return kept.select("conv_id", "turn", "question", *[cap_condition(users, c).alias(cap_column(c)) for c in caps])


def qa_pairs(spark: SparkSession, sf_dir: str, cap: int | None = None, caps: tuple[int, ...] = (),
             pages: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """User turn + following assistant turn (if any) + conversation document
    (+ page). The (conv_id, turn) join cannot be skewed by one conversation;
    the per-conversation joins run on (conv_id, salt), hot conversations salted."""
    conv = read_table(spark, sf_dir, "conversations")
    answers = conv.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer_text"))
    users = user_turns(spark, sf_dir, cap, caps)
    # counted on the raw user turns (two columns, no ordinal): a key hot after
    # the cap is hot before it, and salting a cooler key is harmless
    hot = hot_keys(conv.where(F.col("role") == "user").select("conv_id"), "conv_id", hot_rows)
    pairs = users.join(answers, ["conv_id", "turn"], "left")
    # documents and pages of no conversation are not moved
    bitmap = key_bitmap(conv.where(F.col("role") == "user").select("conv_id"), "conv_id")
    docs = read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("conv_id"), F.col("text").alias("doc_text"))
    dims = [docs]
    if pages:
        dims.append(read_table(spark, sf_dir, "pages").select(
            F.col("page_id").alias("conv_id"), F.col("html").alias("page_html"), F.col("url").alias("page_url")))
    dims = [sift(dim, bitmap, "conv_id") for dim in dims]
    if hot is None:
        for dim in dims:
            pairs = pairs.join(dim, "conv_id", "left")
        return pairs
    pairs = salt_big(pairs, hot, "conv_id", ["conv_id", "turn"])
    for dim in dims:
        pairs = pairs.join(salt_small(dim, hot, "conv_id"), ["conv_id", SALT], "left")
    return pairs.drop(SALT)


def _answers_struct() -> Column:
    text = F.when(F.col("answer_text").isNotNull(), F.array(F.col("answer_text"))) \
            .otherwise(F.array().cast("array<string>"))
    return F.struct(text.alias("text"))


def span_qa(spark: SparkSession, sf_dir: str, cap: int | None = None) -> DataFrame:
    """D1 rows (+ ``source``, ``rec_key``)."""
    return qa_pairs(spark, sf_dir, cap).select(
        F.lit("squad").alias("source"), rec_key("squad").alias("rec_key"),
        "question", F.col("doc_text").alias("context"), _answers_struct().alias("answers"))


def span_qa_v2(spark: SparkSession, sf_dir: str, cap: int | None = None) -> DataFrame:
    """D2 rows: D1 plus ``is_impossible`` (no assistant reply follows)."""
    return qa_pairs(spark, sf_dir, cap).select(
        F.lit("squad_v2").alias("source"), rec_key("squad_v2").alias("rec_key"),
        "question", F.col("doc_text").alias("context"), _answers_struct().alias("answers"),
        F.col("answer_text").isNull().alias("is_impossible"))


def _obj(**fields) -> Column:
    return F.struct(*[c.alias(k) for k, c in fields.items()])


def evidence_fields(p: DataFrame) -> DataFrame:
    """Adds the three polymorphic JSON fields built from document and page."""
    d, html, url = F.col("doc_text"), F.col("page_html"), F.col("page_url")
    shape = F.pmod(F.col("conv_id"), F.lit(6))
    j = F.to_json
    entity_pages = (
        F.when(shape == 0, j(F.array(_obj(wiki_context=d))))
         .when(shape == 1, j(F.array(_obj(wiki_context=F.lit("  "), text=d))))
         .when(shape == 2, F.lit("[]"))
         .when(shape == 4, F.lit("[{}]"))
         .when(shape == 5, j(F.array(_obj(text=F.lit(None).cast("string")), _obj(text=d))))
    )
    evidence = (
        F.when(shape == 1, j(F.array(html)))
         .when(shape == 2, j(F.array(_obj(text=F.lit(""), value=d))))
         .when(shape == 4, F.lit("[]"))
         .when(shape == 5, j(F.array(F.array(d))))
    )
    search_results = (
        F.when(shape == 2, F.lit("[]"))
         .when(shape == 3, j(F.array(_obj(snippet=url, title=d))))
         .when(shape == 4, j(_obj(zz=F.array(_obj(snippet=d)), aa=_obj(title=url))))
         .when(shape == 5, j(_obj(d=F.array(url))))
    )
    return p.withColumns({"entity_pages": entity_pages, "evidence": evidence, "search_results": search_results})


def evidence_qa(spark: SparkSession, sf_dir: str, cap: int | None = None) -> DataFrame:
    """D3 rows: question, ``answer.value`` and three polymorphic JSON fields."""
    p = evidence_fields(qa_pairs(spark, sf_dir, cap, pages=True))
    return p.select(
        F.lit("trivia_qa").alias("source"), rec_key("trivia_qa").alias("rec_key"),
        "question", F.struct(F.col("answer_text").alias("value")).alias("answer"),
        "entity_pages", "evidence", "search_results")


TYPED_FORMS = ("lists", "maps", "structs")


def typed_evidence_qa(spark: SparkSession, sf_dir: str, form: str) -> DataFrame:
    """D3 rows whose context fields have real nested types: lists of structs
    and strings; lists of maps, and a map of lists to walk; or structs (of
    parallel lists, which is no list, and one to walk)."""
    p = qa_pairs(spark, sf_dir, pages=True)
    d, html, url = F.col("doc_text"), F.col("page_html"), F.col("page_url")
    shape = F.pmod(F.col("conv_id"), F.lit(6))
    null, text = F.lit(None).cast("string"), "string"

    def chosen(kind: str, *cases):
        out = F.lit(None).cast(kind)
        for n, value in cases:
            out = F.when(shape == n, value.cast(kind)).otherwise(out)
        return out

    if form == "lists":
        page = lambda w, t: _obj(wiki_context=w.cast(text), text=t.cast(text))
        hit = lambda s, t: _obj(snippet=s.cast(text), title=t.cast(text))
        pages, hits = "array<struct<wiki_context:string,text:string>>", "array<struct<snippet:string,title:string>>"
        fields = {
            "entity_pages": chosen(pages, (0, F.array(page(d, null))), (1, F.array(page(F.lit("  "), d))), (2, F.array()), (4, F.array(page(null, null))),
                                   (5, F.array(page(null, null), page(null, d)))),
            "evidence": chosen("array<string>", (1, F.array(html)), (2, F.array(F.lit(""))), (4, F.array())),
            "search_results": chosen(hits, (2, F.array(hit(null, url))), (3, F.array(hit(url, d))), (4, F.array()))}
    elif form == "maps":
        hits = "map<string,array<struct<snippet:string,title:string>>>"
        hit = lambda s, t: F.array(_obj(snippet=s.cast(text), title=t.cast(text)))
        none = F.array().cast("array<struct<snippet:string,title:string>>")
        fields = {
            "entity_pages": chosen("array<map<string,string>>", (0, F.array(F.create_map(F.lit("content"), d))),
                                   (1, F.array(F.create_map(F.lit("wiki_context"), F.lit(""), F.lit("text"), F.lit("  ")))), (2, F.array())),
            "evidence": chosen("array<struct<text:string,value:string>>", (1, F.array(_obj(text=null, value=html))), (2, F.array(_obj(text=F.lit(""), value=d)))),
            "search_results": chosen(hits, (3, F.create_map(F.lit("zz"), hit(F.lit("  "), url), F.lit("aa"), hit(null, d))),
                                     (4, F.create_map(F.lit("zz"), none, F.lit("aa"), hit(url, null))), (5, F.create_map()))}
    elif form == "structs":
        walked = "struct<zz:struct<description:string,title:string>,aa:array<struct<snippet:string>>>"
        zz = lambda a, b: _obj(description=a.cast(text), title=b.cast(text))
        aa = lambda s: F.array(_obj(snippet=s.cast(text)))
        fields = {
            "entity_pages": chosen("struct<wiki_context:array<string>>", (0, _obj(wiki_context=F.array(d))), (3, _obj(wiki_context=F.array(d)))),
            "evidence": chosen("array<array<string>>", (1, F.array(F.array(d)))),
            "search_results": chosen(walked, (0, _obj(zz=zz(d, null), aa=aa(url))), (1, _obj(zz=F.lit(None).cast("struct<description:string,title:string>"), aa=aa(url))),
                                     (2, _obj(zz=zz(F.lit(""), F.lit(" ")), aa=aa(d))))}
    else:
        raise ValueError(f"unknown form {form!r}; choose from {TYPED_FORMS}")
    return p.select("question", F.struct(F.col("answer_text").alias("value")).alias("answer"), *[c.alias(k) for k, c in fields.items()])
