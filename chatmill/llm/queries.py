"""The registered queries opN_<name> and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversation_repair, cross_tokenizer, decontaminate, fingerprints, neardup, pii, quality, sharding, suffix_dedup, token_files, toxicity, warc
from chatmill.session import delete_at_exit, scratch_path

from .common import table

SHARDS = 24


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = neardup.near_duplicates(table(spark, sf_dir, "documents"), size=4)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary())
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), vocabulary(), path)
    delete_at_exit(spark, path)
    return token_files.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit_to(docs, table(spark, sf_dir, "labels")))
    held = toxicity.fold(F.col("doc_id"), toxicity.FOLDS) == toxicity.HELD_FOLD
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    held = toxicity.fold(F.col("doc_id"), quality.FOLDS) == quality.HELD_FOLD
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    delete_at_exit(spark, path)
    records, _ = warc.read_warc(spark, path, strict=True)      # an unreadable record is an error, not a missing row
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    found = conversation_repair.repair_conversations(conversation_repair.damage(turns))
    ids = turns.select("conv_id").distinct()
    counts = [F.coalesce(found[c], F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return ids.join(found, ids.conv_id.eqNullSafe(found.conv_id), "left").select(
        ids.conv_id, *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = cross_tokenizer.align_tokenizers(table(spark, sf_dir, "documents"), vocabulary(), vocabulary("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    scored = cross_tokenizer.score_links(aligned.select("doc_id", "n_a", "n_b", "n_links", digest, "pairs"))
    # every token has bytes, so a cut is the end of one token of each: a link
    return scored.select("doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", "groups_sha256")


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find_pii(docs, pii.fit(docs))
    base = F.filter("spans", lambda s: s["base"])
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(kind) for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


QUERIES = {f.__name__: f for f in (
    op1_fingerprints, op2_toxicity, op3_warc, op4_bpe, op5_decontamination, op6_quality,
    op7_token_files, op8_sharding, op9_neardup, op10_suffix_dedup, op11_conversation_repair,
    op12_token_alignment, op13_pii)}
ORACLE_SQL = {"op3_warc": warc.SQL, "op5_decontamination": decontaminate.SQL}
