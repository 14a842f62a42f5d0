"""Plug-in tokenizer file: Spark UDF results equal the library's own encode."""

import pytest
from pyspark.sql import functions as F

from chatmill.functions.templates import build_text
from chatmill.operators.encode import SubwordTokenizer, encode_raw, tokenize_and_mask
from chatmill.plans.prepare import build_records
from chatmill.session import scratch_path

from conftest import SF_SMALL

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def tok_file():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_a_loaded_tokenizer_stays_on_the_driver(spark, tok_file):
    """The closure that goes to the workers is as small after the driver has loaded the file."""
    from pyspark import cloudpickle

    from chatmill.functions import subword
    from chatmill.session import ship_package
    ship_package(spark)
    before = len(cloudpickle.dumps(subword.load))
    assert subword.load(tok_file) is subword.load(tok_file)
    assert len(cloudpickle.dumps(subword.load)) == before < 10_000


def test_subword_ids_match_library(spark, tok_file):
    tok = SubwordTokenizer(tok_file).ship(spark)
    recs = build_records(spark, SF_SMALL).select("rec_key", build_text().alias("text"))
    got = {r.rec_key: r.ids for r in recs.select("rec_key", tok.ids("text").alias("ids")).collect()}
    lib = tok._tok()
    for r in recs.collect():
        assert got[r.rec_key] == lib.encode(r.text, add_special_tokens=False).ids
    assert len(tok.marker_ids) == 2       # <|im_start|> and assistant are added tokens


def test_subword_paths_run(spark, tok_file):
    tok = SubwordTokenizer(tok_file).ship(spark)
    recs = build_records(spark, SF_SMALL)
    w = tokenize_and_mask(recs, tok, 128).collect()
    r = encode_raw(recs, tok, 128).collect()
    assert w and r
    assert all(len(x.input_ids) <= 128 and x.labels.count(-100) >= 2 for x in w)
