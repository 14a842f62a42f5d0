"""Bench: headline jobs on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

prepare      sources -> records -> exact split -> JSONL + metadata (writes)
pretokenize  train/val JSONL -> window path (4096) -> ordered Parquet (writes)
train_data   raw path (2048) of the train JSONL + padded batches (noop sink)
plus single operators (noop sink): context tiers and the exact split over
the whole source tables; vocabulary fit and the 256-token window over the
prepared train split.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from chatmill.operators import encode as E  # noqa: E402
from chatmill.operators import vocab as V  # noqa: E402
from chatmill.operators.split import exact_split, seeded_shuffle  # noqa: E402
from chatmill.plans import train_data as TD  # noqa: E402
from chatmill.plans.pretokenize import pretokenize  # noqa: E402
from chatmill.plans.prepare import build_records, prepare  # noqa: E402
from chatmill.functions.templates import build_text  # noqa: E402
from chatmill.session import local_session, scratch_path  # noqa: E402
from chatmill.sources import tables  # noqa: E402
from chatmill.sources.files import scan_jsonl  # noqa: E402
from chatmill.operators.context import resolve_context  # noqa: E402


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="chatmill-bench")
    tok = E.Tokenizer()
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    # warm the JVM / Python workers once, untimed
    noop(tables.user_turns(spark, sf_dir))

    out = scratch_path(spark, "bench")
    meta = timed("prepare", lambda: prepare(spark, sf_dir, out))
    timed("pretokenize", lambda: pretokenize(spark, f"{out}/train.jsonl", f"{out}/val.jsonl", out, tok))

    def train_data():
        _, df = TD.load_split(spark, None, f"{out}/train.jsonl", tok)
        noop(TD.collate(df, tok, batch_size=2))
    timed("train_data", train_data)

    train = scan_jsonl(spark, f"{out}/train.jsonl", positioned=False)
    timed("resolve_context", lambda: noop(resolve_context(tables.evidence_qa(spark, sf_dir))))
    timed("exact_split", lambda: noop(exact_split(seeded_shuffle(build_records(spark, sf_dir)))))
    timed("fit_vocab", lambda: noop(V.fit_vocab(train.select(tok.tokens(build_text()).alias("tokens")), "tokens")))
    timed("window_256", lambda: noop(E.tokenize_and_mask(train, tok, 256)))

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_wall_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir).replace("sf", ""), "cpus": int(cpus),
                      "rows": {"records": meta["num_total"], "train": meta["num_train"], "val": meta["num_val"]}}))
    spark.stop()


if __name__ == "__main__":
    main()
