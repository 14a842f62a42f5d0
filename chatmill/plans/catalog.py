"""One query per operator of the inventory, over the driver's tables.

Every callable takes (spark, sf_dir) and returns a DataFrame whose columns
match the DuckDB oracle of the same key (``chatmill.plans.oracle``). Arrays
are compared through digests: ``md5(array_join(ids, ','))``.

Steps that write (prepare, pretokenize) stage their outputs once per
process and session under the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmill.config import ENTITY_PAGE_KEYS, PY_WHITESPACE
from chatmill.functions import arrays as A
from chatmill.functions import text as TX
from chatmill.functions.templates import build_text, render_instruction, render_output
from chatmill.operators import encode as E
from chatmill.operators import records as R
from chatmill.operators import vocab as V
from chatmill.operators.context import context_fields, resolve_context, string_at
from chatmill.operators.ordinal import scan_prefix, with_ordinal
from chatmill.operators.split import HASH, exact_split, preview, seeded_shuffle, split_counts
from chatmill.plans import pretokenize as PT
from chatmill.plans import train_data as TD
from chatmill.plans.prepare import build_records, metadata_frame, prepare, records_of, source_records, union_sources
from chatmill.session import scratch_path
from chatmill.sources import qa_files as QF
from chatmill.sources import sinks, tables
from chatmill.sources.files import scan_jsonl, scan_tokenized
from chatmill.sources.schemas import RECORD

TOK = E.Tokenizer()
SEED, VAL_FRACTION = 42, 0.02
WINDOW_L, RAW_L, HEAD_N, VOCAB_N = 4096, 2048, 100, 4096
# lengths of the queries about cropping and dropping, chosen so that rows are cropped and dropped
CROP_L, TRUNCATE_L, ANSWER_K = 256, 128, 60
SUPERVISED_LS = (100, 200, 400, 800, RAW_L)
CAP_N, MIX_N = 100, 150
MARKER = TOK.marker_ids                   # <|im_start|> assistant
USER_TURN = TOK.encode_py("<|im_start|>user")
END_THEN_MARKER = TOK.encode_py("<|im_end|>\n<|im_start|>assistant")
END_ID = TOK.encode_py("<|im_end|>")
TALLIED = {"marker": MARKER, "end": END_ID, "end_then_marker": END_THEN_MARKER, "stop": TOK.encode_py("."), "two_words": TOK.encode_py("de la")}

_memo: dict = {}


def digest(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.md5(F.array_join(c.cast("array<string>"), ","))


def _key(spark, sf, *rest):
    return (spark.sparkContext.applicationId, sf.rstrip("/"), *rest)


def prepared(spark: SparkSession, sf: str) -> str:
    k = _key(spark, sf, "prepare")
    if k not in _memo:
        out = scratch_path(spark, "prepared")
        prepare(spark, sf, out, seed=SEED, val_fraction=VAL_FRACTION)
        _memo[k] = out
    return _memo[k]


def pretokenized(spark: SparkSession, sf: str, splits=("train", "val")) -> str:
    k = _key(spark, sf, "pretokenize", splits)
    if k not in _memo:
        src, out = prepared(spark, sf), scratch_path(spark, "tokenized")
        for s in splits:
            PT.pretokenize_split(spark, s, f"{src}/{s}.jsonl", out, TOK, WINDOW_L)
        _memo[k] = out
    return _memo[k]


def records(spark, sf) -> DataFrame:
    return build_records(spark, sf)


def labeled(spark, sf) -> DataFrame:
    return exact_split(seeded_shuffle(records(spark, sf), SEED), VAL_FRACTION, SEED)


def token_rows(spark, sf, name="input_ids") -> DataFrame:
    return E.text_ids(records(spark, sf), TOK, keep=["rec_key"], name=name)


def _tok_digests(df: DataFrame, *keep) -> DataFrame:
    return df.select(*keep, F.size("input_ids").cast("long").alias("n_ids"), digest("input_ids").alias("ids_md5"),
                     digest("labels").alias("labels_md5"), digest("attention_mask").alias("mask_md5"))


# --- scans / sources ---------------------------------------------------------
def q_scan_span_qa(spark, sf):
    d = tables.span_qa(spark, sf)
    return d.select("rec_key", "question", "context", F.size("answers.text").cast("long").alias("n_answers"),
                    F.try_element_at("answers.text", F.lit(1)).alias("answer"))


def q_scan_span_qa_v2(spark, sf):
    d = tables.span_qa_v2(spark, sf)
    return d.select("rec_key", "question", "context", F.size("answers.text").cast("long").alias("n_answers"),
                    F.try_element_at("answers.text", F.lit(1)).alias("answer"), "is_impossible")


def q_scan_evidence_qa(spark, sf):
    d = tables.evidence_qa(spark, sf)
    return d.select("rec_key", "question", F.col("answer.value").alias("answer_value"),
                    F.col("entity_pages").isNotNull().alias("has_entity_pages"),
                    F.col("evidence").isNotNull().alias("has_evidence"),
                    F.col("search_results").isNotNull().alias("has_search_results"))


def q_scan_jsonl(spark, sf):
    df = with_ordinal(scan_jsonl(spark, f"{prepared(spark, sf)}/train.jsonl"))
    return df.select("ordinal", "instruction", "output")


def q_scan_tokenized(spark, sf):
    df = with_ordinal(scan_tokenized(spark, f"{pretokenized(spark, sf)}/train_tokenized"))
    return _tok_digests(df, "ordinal")


def q_resolve_split(spark, sf):
    base = prepared(spark, sf)
    tok_dir = pretokenized(spark, sf, ("train",))
    out = []
    for split, tdir, raw in (("train", f"{tok_dir}/train_tokenized", f"{base}/train.jsonl"),
                             ("val", f"{tok_dir}/val_tokenized", f"{base}/val.jsonl"),
                             ("test", f"{tok_dir}/test_tokenized", f"{base}/test.jsonl")):
        found = TD.load_split(spark, tdir, raw, TOK, RAW_L)
        if found is not None:
            origin, df = found
            out.append(_tok_digests(df, "ordinal").select(F.lit(split).alias("split"), F.lit(origin).alias("origin"), "*"))
    return out[0].unionByName(out[1])


def q_include_sources(spark, sf):
    d = build_records(spark, sf, include=["squad", "trivia_qa"])
    return d.select("source", "rec_key", F.md5("instruction").alias("instruction_md5"), F.md5("output").alias("output_md5"))


# --- projections ---------------------------------------------------------------
def q_clean_text(spark, sf):
    c = tables.read_table(spark, sf, "conversations")
    padded = F.concat(F.lit(PY_WHITESPACE), F.col("text"), F.lit(PY_WHITESPACE))
    return c.select("conv_id", "turn", TX.clean_text("text").alias("cleaned"),
                    (TX.clean_text(padded) == TX.clean_text("text")).alias("padded_same"))


def q_first_answer(spark, sf):
    d = R.first_answer(tables.span_qa(spark, sf))
    return d.select("rec_key", F.col("_n_answers").cast("long").alias("n_answers"), "answer")


def q_render_instruction(spark, sf):
    d = tables.span_qa(spark, sf)
    return d.select("rec_key", render_instruction(F.coalesce("question", F.lit("")),
                                                  F.coalesce("context", F.lit(""))).alias("instruction"))


def q_render_output(spark, sf):
    d = R.first_answer(tables.span_qa(spark, sf)).where(F.col("answer").isNotNull())
    return d.select("rec_key", render_output("answer").alias("output"))


def q_make_records(spark, sf):
    return R.span_qa_records(tables.span_qa(spark, sf)).select("source", "rec_key", "instruction", "output")


def q_resolve_context(spark, sf):
    return resolve_context(tables.evidence_qa(spark, sf)).select("rec_key", "context")


def q_resolve_context_typed(spark, sf):
    """Three Parquet sources whose context fields are lists, maps and structs."""
    parts = []
    for form in tables.TYPED_FORMS:
        k = _key(spark, sf, "typed", form)
        if k not in _memo:
            _memo[k] = scratch_path(spark, f"typed-{form}")
            tables.typed_evidence_qa(spark, sf, form).write.parquet(_memo[k])
        d = resolve_context(QF.read_evidence_qa(spark, _memo[k], "parquet"))
        parts.append(d.select(F.lit(form).alias("form"), F.md5("question").alias("question_md5"), F.md5("context").alias("context_md5")))
    return union_sources(parts).groupBy("form", "question_md5", "context_md5").agg(F.count(F.lit(1)).alias("n"))


def q_context_fields(spark, sf):
    return context_fields(tables.evidence_qa(spark, sf))


def q_build_text(spark, sf):
    return records(spark, sf).select("rec_key", build_text().alias("text"))


def q_preview(spark, sf):
    return preview(labeled(spark, sf))


# --- filters -------------------------------------------------------------------
def q_filter_span_qa(spark, sf):
    return R.filter_span_qa(tables.span_qa(spark, sf)).select("rec_key")


def q_filter_answerable(spark, sf):
    return R.filter_answerable(tables.span_qa_v2(spark, sf)).select("rec_key", "is_impossible")


def q_filter_evidence_qa(spark, sf):
    return R.filter_evidence_qa(tables.evidence_qa(spark, sf)).select("rec_key")


def q_window_boundary(spark, sf):
    w = E.window_and_mask(token_rows(spark, sf), MARKER, CROP_L, ANSWER_K, keep=["rec_key"])
    return _tok_digests(w, "rec_key")


def q_filter_min_supervised(spark, sf):
    """Rows that keep 8 supervised ids at each length; shorter heads cut the
    answer behind the marker, so rows drop."""
    recs = records(spark, sf)
    return E.encode_raw(recs, TOK, SUPERVISED_LS, keep=["rec_key"]).select(F.col("max_length").cast("long"), "rec_key")


def q_filter_nonempty(spark, sf):
    """Window ids of every record of all sources, and ids of every user turn's
    reply; a turn without one has an empty text."""
    windows = E.window_and_mask(token_rows(spark, sf), MARKER, WINDOW_L, keep=["rec_key"]).select("rec_key", "input_ids")
    replies = tables.qa_pairs(spark, sf).select(tables.rec_key("reply").alias("rec_key"), TOK.ids(F.coalesce("answer_text", F.lit(""))).alias("input_ids"))
    return E.filter_nonempty(union_sources([windows, replies])).select("rec_key", F.size("input_ids").cast("long").alias("n_ids"), digest("input_ids").alias("ids_md5"))


def q_marker_tally(spark, sf):
    """How many texts of each source hold a needle so many times."""
    ids = E.text_ids(records(spark, sf), TOK, keep=["source"])
    return E.marker_tally(ids, TALLIED, by=["source"]).select("needle", "source", "n_markers", "n_rows")


# --- aggregations ----------------------------------------------------------------
def q_split_counts(spark, sf):
    return split_counts(labeled(spark, sf))


def q_dataset_sizes(spark, sf):
    base = prepared(spark, sf)
    (_, train), evald = TD.load_datasets(spark, train_dir=f"{pretokenized(spark, sf)}/train_tokenized",
                                         eval_file=f"{base}/val.jsonl", tok=TOK, max_length=RAW_L)
    t = train.agg(F.count(F.lit(1)).alias("n")).select(F.lit("train").alias("split"), "n")
    e = evald[1].agg(F.count(F.lit(1)).alias("n")).select(F.lit("eval").alias("split"), "n")
    return t.unionByName(e)


def q_supervised_tokens(spark, sf):
    w = E.window_and_mask(token_rows(spark, sf), MARKER, WINDOW_L, keep=["rec_key"])
    return E.supervised_tokens(w).select("rec_key", "n_supervised")


# --- caps, order, split, union ---------------------------------------------------
def q_prefix_cap(spark, sf):
    return tables.user_turns(spark, sf, CAP_N)


def q_mix_caps(spark, sf):
    d = build_records(spark, sf, train_size=MIX_N)
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("n_records"))


def q_head_cap(spark, sf):
    found = TD.load_split(spark, None, f"{prepared(spark, sf)}/train.jsonl", TOK, RAW_L, max_samples=HEAD_N)
    return _tok_digests(found[1], "ordinal")


def q_prefix_cap_json(spark, sf):
    df = scan_prefix(spark, f"{prepared(spark, sf)}/train.jsonl", CAP_N, "json", RECORD)
    return df.select("ordinal", "instruction", "output")


def q_head_cap_tokenized(spark, sf):
    found = TD.load_split(spark, f"{pretokenized(spark, sf)}/train_tokenized", None, TOK, max_samples=HEAD_N)
    return _tok_digests(found[1], "ordinal")


def q_seeded_shuffle(spark, sf):
    return seeded_shuffle(records(spark, sf), SEED).select("rec_key", HASH)


def q_exact_split(spark, sf):
    return labeled(spark, sf).select("rec_key", "split")


def q_union_sources(spark, sf):
    parts = [source_records(spark, sf, s, None) for s in tables.SOURCES]
    return union_sources(parts).select("source", "rec_key")


def qa_files(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The three corpora, written as JSON lines once and read back."""
    k = _key(spark, sf, "qa_files")
    if k not in _memo:
        out = scratch_path(spark, "qa")
        tables.span_qa(spark, sf).select("question", "context", "answers").write.json(f"{out}/squad")
        tables.span_qa_v2(spark, sf).select("question", "context", "answers", "is_impossible").write.json(f"{out}/squad_v2")
        QF.write_evidence_qa(tables.evidence_qa(spark, sf), f"{out}/trivia_qa")
        _memo[_key(spark, sf, "qa_path")] = out
        _memo[k] = {s: read(spark, f"{out}/{s}") for s, read in QF.READERS.items()}
    return _memo[k]


def q_read_qa_files(spark, sf):
    fields = {"squad": ["context"], "squad_v2": ["context"], "trivia_qa": ["answer.value"]}
    parts = [d.select("source", F.md5(F.concat_ws("|", "question", *fields[s])).alias("row_md5")) for s, d in qa_files(spark, sf).items()]
    return union_sources(parts).groupBy("source", "row_md5").agg(F.count(F.lit(1)).alias("n"))


def q_prepare_sources(spark, sf):
    d = records_of(qa_files(spark, sf))
    return d.groupBy("source", F.md5("instruction").alias("instruction_md5"), F.md5("output").alias("output_md5")).agg(F.count(F.lit(1)).alias("n"))


# --- scalar / array functions ------------------------------------------------------
def q_py_trim(spark, sf):
    d = tables.read_table(spark, sf, "documents")
    return d.select("doc_id",
                    (TX.py_rtrim(F.concat("text", F.lit(PY_WHITESPACE))) == F.col("text")).alias("rtrim_same"),
                    F.length(TX.py_trim(F.concat(F.lit(PY_WHITESPACE + "\u200b"), "text", F.lit(" \ufeff"))))
                    .cast("long").alias("n_chars"))


def q_first_nonempty_key(spark, sf):
    d = tables.evidence_qa(spark, sf).select("rec_key", F.try_parse_json("entity_pages").alias("ep"))
    d = d.select("rec_key", *[string_at(F.col("ep"), f"$[0].{k}").alias(k) for k in ENTITY_PAGE_KEYS])
    return d.select("rec_key", TX.first_nonempty(*ENTITY_PAGE_KEYS).alias("picked"))


def q_find_subarray(spark, sf):
    d = token_rows(spark, sf)
    needles = {"pos_marker": MARKER, "pos_user": USER_TURN, "pos_end_marker": END_THEN_MARKER,
               "pos_end": END_ID, "pos_empty": []}
    return d.select("rec_key", *[A.find_subarray("input_ids", n).cast("long").alias(k) for k, n in needles.items()])


def q_mask_labels(spark, sf):
    d = token_rows(spark, sf).select("rec_key", "input_ids", A.find_subarray("input_ids", MARKER).alias("pos"))
    # a filter on the position would be pushed down and encode the text twice
    row = F.struct("rec_key", digest(A.mask_prefix("input_ids", F.col("pos") + F.lit(len(MARKER)))).alias("labels_md5"))
    return d.select(F.inline(F.when(F.col("pos") >= 0, F.array(row)).otherwise(F.array().cast("array<struct<rec_key:string,labels_md5:string>>"))))


def q_mask_labels_keep(spark, sf):
    r = E.encode_raw(records(spark, sf), TOK, RAW_L, keep=["rec_key"])
    return r.select("rec_key", digest("labels").alias("labels_md5"),
                    F.size(F.array_remove("labels", F.lit(-100))).cast("long").alias("n_supervised"))


def q_truncate_head(spark, sf):
    d = token_rows(spark, sf).select("rec_key", A.truncate_head("input_ids", TRUNCATE_L).alias("ids"))
    return d.select("rec_key", F.size("ids").cast("long").alias("n_ids"), digest("ids").alias("ids_md5"))


def q_write_jsonl(spark, sf):
    parts = [scan_jsonl(spark, f"{prepared(spark, sf)}/{s}.jsonl", positioned=False).select(F.lit(s).alias("split"), "instruction", "output") for s in ("train", "val")]
    return union_sources(parts)


# --- tokenization and batching -----------------------------------------------------
def q_split_tokens(spark, sf):
    d = records(spark, sf).select("rec_key", TOK.tokens(build_text()).alias("t"))
    return d.select("rec_key", F.size("t").cast("long").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens_md5"))


def q_encode_ids(spark, sf):
    d = token_rows(spark, sf)
    return d.select("rec_key", F.size("input_ids").cast("long").alias("n_ids"), digest("input_ids").alias("ids_md5"))


def q_encode_raw_path(spark, sf):
    return _tok_digests(E.encode_raw(records(spark, sf), TOK, keep=["rec_key"]), "rec_key")


def q_pad_batches(spark, sf):
    found = TD.load_split(spark, None, f"{prepared(spark, sf)}/train.jsonl", TOK, RAW_L)
    p = TD.collate(found[1], TOK, batch_size=2, mixed_precision=True)
    return p.select("ordinal", "batch_id", "width", digest("input_ids").alias("ids_md5"),
                    digest("attention_mask").alias("mask_md5"), digest("labels").alias("labels_md5"))


def q_fit_vocab(spark, sf):
    d = records(spark, sf).select(TOK.tokens(build_text()).alias("tokens"))
    return V.fit_vocab(d, "tokens", VOCAB_N)


def q_encode_vocab(spark, sf):
    recs = records(spark, sf).select("rec_key", TOK.tokens(build_text()).alias("tokens"))
    vocab = V.fit_vocab(recs, "tokens", VOCAB_N)
    ids = V.encode_with_vocab(recs, vocab, "tokens", unk_id=-1, max_vocab=VOCAB_N)
    return ids.select("rec_key", F.size("input_ids").cast("long").alias("n_ids"), digest("input_ids").alias("ids_md5"))


def q_pretokenize_split(spark, sf):
    base = pretokenized(spark, sf)
    parts = [_tok_digests(scan_tokenized(spark, f"{base}/{s}_tokenized", positioned=False)).select(
        F.lit(s).alias("split"), "*") for s in ("train", "val")]
    return parts[0].unionByName(parts[1])


def q_stream_prepare(spark, sf):
    from chatmill.streaming.prepare import read_records, stream_prepare
    qa_files(spark, sf)
    parts = []
    for source in tables.SOURCES:
        out = stream_prepare(spark, source, f"{_memo[_key(spark, sf, 'qa_path')]}/{source}", scratch_path(spark, "stream-prepare"))
        parts.append(read_records(spark, out).select(F.lit(source).alias("source"), F.md5("instruction").alias("instruction_md5"), F.md5("output").alias("output_md5")))
    return union_sources(parts).groupBy("source", "instruction_md5", "output_md5").agg(F.count(F.lit(1)).alias("n"))


def q_stream_tokenize(spark, sf):
    from chatmill.streaming.rowwise import stream_pretokenize
    out = stream_pretokenize(spark, f"{prepared(spark, sf)}/train.jsonl", scratch_path(spark, "stream"),
                             TOK, WINDOW_L)
    return _tok_digests(spark.read.parquet(out))


# --- sinks -------------------------------------------------------------------------
def q_split_metadata(spark, sf):
    m = metadata_frame(split_counts(labeled(spark, sf)), ["squad", "squad_v2", "trivia_qa"], SEED)
    return m.select("num_total", "num_train", "num_val", F.array_join("include", ",").alias("include"),
                    F.col("seed").cast("long").alias("seed"), "system")


def q_write_tokenized(spark, sf):
    base = pretokenized(spark, sf)
    return union_sources([_tok_digests(with_ordinal(scan_tokenized(spark, f"{base}/{s}_tokenized")), "ordinal").select(F.lit(s).alias("split"), "*")
                          for s in ("train", "val")])


def q_save_mode(spark, sf):
    path = scratch_path(spark, "savemode")
    recs = records(spark, sf)
    sinks.write_jsonl(recs, path, sinks.save_mode(False))
    try:
        sinks.write_jsonl(recs, path, sinks.save_mode(False))
        second = "written"
    except AnalysisException as e:
        if e.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        second = "refused"
    sinks.write_jsonl(recs, path, sinks.save_mode(True))
    back = scan_jsonl(spark, path, positioned=False)
    return back.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("errorifexists").alias("mode"), F.lit(second).alias("second_write"), "n_rows")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
