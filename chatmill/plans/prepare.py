"""Prepare: QA sources -> records -> seeded exact split -> JSONL + metadata.

scan -> cap (L1) -> clean/filter (J1, F*) -> context (J6) -> records (J5)
-> union (U1) -> shuffle key (O1) -> stage -> cutoff passes (O2) -> write.

The union is staged once as Parquet in the shared checkpoint folder so the
counting passes and both writers read it instead of recomputing the joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmill.config import (DEFAULT_INCLUDE, DEFAULT_SEED, DEFAULT_VAL_FRACTION,
                             NO_CONTEXT_PLACEHOLDER, SCRATCHPAD_TEXT, SYSTEM_PROMPT)
from chatmill.operators import records as R
from chatmill.functions.templates import render_instruction, render_output
from chatmill.operators.context import resolve_context
from chatmill.operators.ordinal import mix_caps, prefix_cap
from chatmill.operators.skew import HOT_ROWS
from chatmill.operators.split import HASH, find_cutoff, label_staged, preview, seeded_shuffle, val_count
from chatmill.sources.schemas import METADATA
from chatmill.session import stage
from chatmill.sources import sinks, tables


def source_records(spark: SparkSession, sf_dir: str, source: str, cap: int | None,
                   system_prompt: str = SYSTEM_PROMPT, scratchpad: str = SCRATCHPAD_TEXT,
                   placeholder: str = NO_CONTEXT_PLACEHOLDER) -> DataFrame:
    tpl = dict(system_prompt=system_prompt, scratchpad=scratchpad)
    if source == "squad":
        return R.span_qa_records(tables.span_qa(spark, sf_dir, cap), **tpl)
    if source == "squad_v2":
        return R.span_qa_v2_records(tables.span_qa_v2(spark, sf_dir, cap), **tpl)
    if source == "trivia_qa":
        return R.evidence_qa_records(tables.evidence_qa(spark, sf_dir, cap), placeholder=placeholder, **tpl)
    raise ValueError(f"unknown source {source!r}; choose from {tables.SOURCES}")


def union_sources(parts: list[DataFrame]) -> DataFrame:
    """Bag union by column name, no dedup."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def build_records_by_union(spark: SparkSession, sf_dir: str, include=DEFAULT_INCLUDE,
                           train_size: int | None = None, **tpl) -> DataFrame:
    """S8 + L2 + U1 as a literal union of per-source plans (each scans and
    joins on its own); kept as the reference shape for tests."""
    if not include:
        raise ValueError("include at least one source")
    caps = mix_caps(train_size) if train_size is not None else {s: None for s in tables.SOURCES}
    return union_sources([source_records(spark, sf_dir, s, caps[s], **tpl) for s in include])


def build_records(spark: SparkSession, sf_dir: str, include=DEFAULT_INCLUDE,
                  train_size: int | None = None, system_prompt: str = SYSTEM_PROMPT,
                  scratchpad: str = SCRATCHPAD_TEXT, placeholder: str = NO_CONTEXT_PLACEHOLDER,
                  struct_of_arrays: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """S8 + L2 + U1 in one pass: the three sources are views of the same
    (user turn, reply, document, page) rows, so they are scanned and joined
    once and each row emits up to one record per source through ``inline``
    (a bag union: nothing is deduplicated). Each source keeps its own cap on
    the raw-row ordinal and its own filters."""
    include = list(include)
    if not include:
        raise ValueError("include at least one source")
    unknown = set(include) - set(tables.SOURCES)
    if unknown:
        raise ValueError(f"unknown sources {sorted(unknown)}; choose from {tables.SOURCES}")
    binding = {s: c for s, c in mix_caps(train_size).items() if s in include} if train_size is not None else {}
    trivia = "trivia_qa" in include
    p = tables.qa_pairs(spark, sf_dir, max(binding.values(), default=None), caps=tuple(sorted(set(binding.values()))), pages=trivia, hot_rows=hot_rows)
    if trivia:
        p = resolve_context(tables.evidence_fields(p), placeholder, "ev_context", struct_of_arrays=struct_of_arrays)
    q, ctx, ans = F.col("question"), F.col("doc_text"), F.col("answer_text")
    texts = F.when(ans.isNotNull(), F.array(ans)).otherwise(F.array().cast("array<string>"))

    def capped(source):
        return F.col(tables.cap_column(binding[source])) if source in binding else F.lit(True)

    # stage 1: each rendered string once, with the per-source keep flags
    cols = {"conv_id": F.col("conv_id"), "turn": F.col("turn"),
            "span_instruction": render_instruction(F.coalesce(q, F.lit("")), F.coalesce(ctx, F.lit("")), system_prompt),
            "span_output": render_output(F.coalesce(ans, F.lit("")), scratchpad),
            "keep_squad": capped("squad") & R.span_qa_keep(q, ctx, texts),
            "keep_squad_v2": capped("squad_v2") & R.answerable(ans.isNull()) & R.span_qa_keep(q, ctx, texts)}
    if trivia:
        cols["trivia_instruction"] = render_instruction(F.coalesce(q, F.lit("")), F.col("ev_context"), system_prompt)
        cols["keep_trivia_qa"] = capped("trivia_qa") & R.evidence_qa_keep(q, ans)
    staged = p.select(*[c.alias(k) for k, c in cols.items()])

    # stage 2: emit 0..3 records per row
    def rec(source, instr, out):
        return F.struct(F.lit(source).alias("source"), tables.rec_key(source).alias("rec_key"),
                        F.col(instr).alias("instruction"), F.col(out).alias("output"))
    parts = {"squad": rec("squad", "span_instruction", "span_output"),
             "squad_v2": rec("squad_v2", "span_instruction", "span_output"),
             "trivia_qa": rec("trivia_qa", "trivia_instruction", "span_output") if trivia else None}
    empty = F.array().cast("array<struct<source:string,rec_key:string,instruction:string,output:string>>")
    emitted = F.concat(*[F.when(F.col(f"keep_{s}"), F.array(parts[s])).otherwise(empty) for s in include])
    return staged.select(F.inline(emitted))


def metadata_frame(counts: DataFrame, include, seed: int, system_prompt: str = SYSTEM_PROMPT) -> DataFrame:
    """D10 from the split counts (one row)."""
    return counts.select(
        "num_total", "num_train", "num_val",
        F.array(*[F.lit(s) for s in include]).alias("include"),
        F.lit(int(seed)).alias("seed"), F.lit(system_prompt).alias("system"))


def prepare(spark: SparkSession, sf_dir: str, out_dir: str, include=DEFAULT_INCLUDE,
            train_size: int | None = None, val_fraction: float = DEFAULT_VAL_FRACTION,
            seed: int = DEFAULT_SEED, overwrite: bool = True, **tpl) -> dict:
    """Run the whole prepare step over the given tables; returns the metadata as a dict."""
    sinks.refuse_existing(spark, outputs(out_dir), overwrite)
    recs = build_records(spark, sf_dir, include, train_size, **tpl)
    return write_prepared(spark, recs, out_dir, include, val_fraction, seed, overwrite, tpl.get("system_prompt", SYSTEM_PROMPT))


def prepare_sources(spark: SparkSession, sources: dict[str, DataFrame], out_dir: str, train_size: int | None = None,
                    val_fraction: float = DEFAULT_VAL_FRACTION, seed: int = DEFAULT_SEED, overwrite: bool = True, **tpl) -> dict:
    """Prepare over independent sources: ``squad``, ``squad_v2``, ``trivia_qa``
    from ``sources.qa_files`` (or any frames of their schemas with a rec_key)."""
    sinks.refuse_existing(spark, outputs(out_dir), overwrite)
    recs = records_of(sources, train_size, **tpl)
    return write_prepared(spark, recs, out_dir, list(sources), val_fraction, seed, overwrite, tpl.get("system_prompt", SYSTEM_PROMPT))


def records_of(sources: dict[str, DataFrame], train_size: int | None = None, system_prompt: str = SYSTEM_PROMPT,
               scratchpad: str = SCRATCHPAD_TEXT, placeholder: str = NO_CONTEXT_PLACEHOLDER) -> DataFrame:
    """S8 + L2 + U1 over independent inputs, capped in source order."""
    if not sources:
        raise ValueError("include at least one source")
    unknown = set(sources) - set(tables.SOURCES)
    if unknown:
        raise ValueError(f"unknown sources {sorted(unknown)}; choose from {tables.SOURCES}")
    caps = mix_caps(train_size) if train_size is not None else {}
    tpl = dict(system_prompt=system_prompt, scratchpad=scratchpad)
    make = {"squad": R.span_qa_records, "squad_v2": R.span_qa_v2_records,
            "trivia_qa": lambda d, **t: R.evidence_qa_records(d, placeholder=placeholder, **t)}
    return union_sources([make[s](prefix_cap(d, caps.get(s)), **tpl) for s, d in sources.items()])


def outputs(out_dir: str) -> list[str]:
    return [f"{out_dir.rstrip('/')}/{name}" for name in ("train.jsonl", "val.jsonl", "metadata.json")]


def write_prepared(spark: SparkSession, recs: DataFrame, out_dir: str, include, val_fraction: float, seed: int,
                   overwrite: bool, system_prompt: str) -> dict:
    """Stage the records once, split them exactly, write everything."""
    mode = sinks.save_mode(overwrite)
    recs = seeded_shuffle(recs, seed)
    path = stage(recs, "records")
    staged = spark.read.parquet(path)
    n_total, cutoff = find_cutoff(staged, val_fraction)      # exact counts come with the cutoff
    labeled = label_staged(spark, path, cutoff)
    n_val = val_count(n_total, val_fraction)
    order = [HASH, "rec_key"]
    out = out_dir.rstrip("/")
    sinks.write_jsonl(labeled.where(F.col("split") == "train"), f"{out}/train.jsonl", mode, order)
    sinks.write_jsonl(labeled.where(F.col("split") == "val"), f"{out}/val.jsonl", mode, order)
    result = {"num_total": n_total, "num_train": n_total - n_val, "num_val": n_val, "include": list(include),
              "seed": int(seed), "system": system_prompt}
    meta = spark.createDataFrame([tuple(result[f.name] for f in METADATA.fields)], METADATA)
    sinks.write_metadata(meta, f"{out}/metadata.json", mode)
    result["preview"] = [r.asDict() for r in preview(labeled).collect()]
    sinks.remove(spark, path)
    return result
