"""Source rows -> instruction records (D5 + source, rec_key)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmill.config import NO_CONTEXT_PLACEHOLDER, SCRATCHPAD_TEXT, SYSTEM_PROMPT
from chatmill.functions.templates import render_instruction, render_output
from chatmill.functions.text import clean_text
from chatmill.operators.context import resolve_context

KEEP = ["source", "rec_key"]


def span_qa_keep(question: Column, context: Column, answers_text: Column) -> Column:
    """F1 as a predicate: question and context non-blank after trim, the
    answer list non-empty (a blank answer passes), first answer not null."""
    texts = F.coalesce(answers_text, F.array().cast("array<string>"))
    return ((clean_text(question) != "") & (clean_text(context) != "") & (F.size(texts) > 0)
            & F.try_element_at(texts, F.lit(1)).isNotNull())


def answerable(is_impossible: Column) -> Column:
    """F2 as a predicate: ``is_impossible`` not truthy (null counts as false)."""
    return ~F.coalesce(is_impossible, F.lit(False))


def evidence_qa_keep(question: Column, answer_value: Column) -> Column:
    """F3 as a predicate: question and trimmed answer value non-blank."""
    return (clean_text(question) != "") & (clean_text(answer_value) != "")


def first_answer(df: DataFrame, name: str = "answer") -> DataFrame:
    """``answers.text[0]`` and the list's truthiness."""
    texts = F.coalesce(F.col("answers.text"), F.array().cast("array<string>"))
    return df.withColumn("_n_answers", F.size(texts)).withColumn(name, F.try_element_at(texts, F.lit(1)))


def filter_span_qa(df: DataFrame) -> DataFrame:
    """question and context non-blank after trim, answer list non-empty.
    A blank answer passes; a null first answer is dropped (declared deviation)."""
    return first_answer(df).where(span_qa_keep(F.col("question"), F.col("context"), F.col("answers.text")))


def filter_answerable(df: DataFrame) -> DataFrame:
    """drop rows whose ``is_impossible`` is truthy (null counts as false)."""
    return df.where(answerable(F.col("is_impossible")))


def filter_evidence_qa(df: DataFrame) -> DataFrame:
    """question and trimmed ``answer.value`` both non-blank."""
    return df.where(evidence_qa_keep(F.col("question"), F.col("answer.value")))


def make_records(df: DataFrame, question: str = "question", answer: str = "answer", context: str = "context",
                 system_prompt: str = SYSTEM_PROMPT, scratchpad: str = SCRATCHPAD_TEXT) -> DataFrame:
    """Project to (source, rec_key, instruction, output)."""
    return df.select(
        *[c for c in KEEP if c in df.columns],
        render_instruction(F.coalesce(F.col(question), F.lit("")), F.coalesce(F.col(context), F.lit("")),
                           system_prompt).alias("instruction"),
        render_output(F.coalesce(F.col(answer), F.lit("")), scratchpad).alias("output"),
    )


def span_qa_records(df: DataFrame, **tpl) -> DataFrame:
    """S1 rows -> records: F1, J2, J5."""
    return make_records(filter_span_qa(df), **tpl)


def span_qa_v2_records(df: DataFrame, **tpl) -> DataFrame:
    """S2 rows -> records: F2 first, then as S1."""
    return span_qa_records(filter_answerable(df), **tpl)


def evidence_qa_records(df: DataFrame, placeholder: str = NO_CONTEXT_PLACEHOLDER, **tpl) -> DataFrame:
    """S3 rows -> records: F3, J6 (never drops for context), J5."""
    kept = filter_evidence_qa(df).select(*KEEP, "question", F.col("answer.value").alias("answer"),
                                         "entity_pages", "evidence", "search_results")
    return make_records(resolve_context(kept, placeholder).drop("entity_pages", "evidence", "search_results"), **tpl)
