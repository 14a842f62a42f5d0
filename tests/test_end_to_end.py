"""Prepare -> pretokenize -> load/collate, streaming parity, save modes."""

import json
import os

import pytest
from pyspark.sql import functions as F

from chatmill.operators.encode import Tokenizer
from chatmill.plans import train_data as TD
from chatmill.plans.prepare import prepare
from chatmill.plans.pretokenize import pretokenize, pretokenize_frame
from chatmill.session import scratch_path
from chatmill.sources import sinks
from chatmill.sources.files import scan_jsonl, scan_tokenized
from chatmill.streaming.rowwise import stream_pretokenize

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def prepared(spark):
    out = scratch_path(spark, "e2e")
    meta = prepare(spark, SF_SMALL, out, train_size=20, val_fraction=0.1)
    return out, meta


def test_prepare_outputs(spark, prepared):
    out, meta = prepared
    n_train = scan_jsonl(spark, f"{out}/train.jsonl", positioned=False).count()
    n_val = scan_jsonl(spark, f"{out}/val.jsonl", positioned=False).count()
    assert (meta["num_train"], meta["num_val"]) == (n_train, n_val)
    assert meta["num_total"] == n_train + n_val and n_val == int(meta["num_total"] * 0.1)
    m = spark.read.json(f"{out}/metadata.json").first()
    assert m.include == ["squad", "squad_v2", "trivia_qa"] and m.seed == 42
    assert {p["split"] for p in meta["preview"]} == {"train", "val"}
    assert all(len(p["instruction"]) <= 500 and len(p["output"]) <= 300 for p in meta["preview"])


def test_jsonl_keeps_non_ascii(spark, prepared):
    out, _ = prepared
    files = [f for f in os.listdir(f"{out}/train.jsonl") if f.endswith(".json")]
    raw = "".join(open(f"{out}/train.jsonl/{f}", encoding="utf-8").read() for f in files)
    assert "\\u00e9" not in raw and any(ord(c) > 127 for c in raw)
    json.loads(raw.splitlines()[0])


def test_pretokenize_then_collate(spark, prepared):
    out, _ = prepared
    tok = Tokenizer()
    res = pretokenize(spark, f"{out}/train.jsonl", f"{out}/val.jsonl", out, tok, max_length=128)
    assert set(res) == {"train", "val"}
    origin, train = TD.load_split(spark, res["train"], f"{out}/train.jsonl", tok)
    assert origin == "tokenized"
    batches = TD.collate(train, tok, batch_size=2).collect()
    assert batches and all(len(r.input_ids) == r.width and r.width % 8 == 0 for r in batches)
    assert TD.load_split(spark, f"{out}/none", f"{out}/none.jsonl", tok) is None
    with pytest.raises(ValueError):
        TD.load_datasets(spark, train_dir=f"{out}/none")


def test_missing_split_is_skipped(spark, prepared):
    out, _ = prepared
    res = pretokenize(spark, f"{out}/train.jsonl", f"{out}/absent.jsonl", scratch_path(spark, "skip"), max_length=64)
    assert res["val"] is None and res["train"] is not None


def test_streaming_matches_batch(spark, prepared):
    out, _ = prepared
    tok = Tokenizer()
    sout = stream_pretokenize(spark, f"{out}/train.jsonl", scratch_path(spark, "stream"), tok, 128)
    digest = lambda df: sorted(tuple(r) for r in df.select(
        F.md5(F.array_join(F.col("input_ids").cast("array<string>"), ",")),
        F.md5(F.array_join(F.col("labels").cast("array<string>"), ","))).collect())
    batch = pretokenize_frame(scan_jsonl(spark, f"{out}/train.jsonl"), tok, 128)
    assert digest(spark.read.parquet(sout)) == digest(batch)


def test_save_mode_guard(spark):
    path = scratch_path(spark, "guard")
    df = spark.createDataFrame([("i", "o")], "instruction string, output string")
    sinks.write_jsonl(df, path, sinks.save_mode(False))
    with pytest.raises(Exception):
        sinks.write_jsonl(df, path, sinks.save_mode(False))
    sinks.write_jsonl(df, path, sinks.save_mode(True))
    assert scan_jsonl(spark, path, positioned=False).count() == 1


@pytest.mark.parametrize("train_size,include", [(None, ("squad", "squad_v2", "trivia_qa")),
                                                (7, ("squad", "squad_v2", "trivia_qa")),
                                                (3, ("trivia_qa", "squad")),
                                                (60, ("squad", "squad_v2", "trivia_qa"))])  # v1 cap not binding
def test_fused_sources_equal_union_of_sources(spark, train_size, include):
    from chatmill.plans.prepare import build_records, build_records_by_union
    cols = ["source", "rec_key", "instruction", "output"]
    a = sorted(tuple(r) for r in build_records(spark, SF_SMALL, include, train_size).select(*cols).collect())
    b = sorted(tuple(r) for r in build_records_by_union(spark, SF_SMALL, include, train_size).select(*cols).collect())
    assert a == b and len(a) > 0


def test_pretokenize_keeps_input_order_across_parts(spark):
    from chatmill.operators.encode import tokenize_and_mask
    from chatmill.operators.ordinal import with_ordinal
    from chatmill.operators.split import seeded_shuffle
    from chatmill.plans.prepare import build_records
    tok = Tokenizer()
    recs = seeded_shuffle(build_records(spark, SF_SMALL, train_size=None))
    path = scratch_path(spark, "order")
    sinks.write_jsonl(recs, f"{path}/in.jsonl", "overwrite", ["shuffle_key", "rec_key"], partitions=5)
    res = pretokenize(spark, f"{path}/in.jsonl", f"{path}/absent.jsonl", path, tok, max_length=128)
    got = [r[0] for r in with_ordinal(scan_tokenized(spark, res["train"])).orderBy("ordinal")
           .select(F.md5(F.array_join(F.col("input_ids").cast("array<string>"), ","))).collect()]
    expected_rows = tokenize_and_mask(recs, tok, 128, keep=["shuffle_key", "rec_key"]) \
        .orderBy("shuffle_key", "rec_key") \
        .select(F.md5(F.array_join(F.col("input_ids").cast("array<string>"), ","))).collect()
    assert got == [r[0] for r in expected_rows] and len(got) > 10
