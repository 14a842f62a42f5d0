"""Command line: ``python -m chatmill {prepare,pretokenize,batches} ...``.

Flag names follow the surveyed scripts so existing invocations carry over;
each subcommand calls the plan function of the same name.
"""

from __future__ import annotations

import argparse
import json

from chatmill import config as C


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="chatmill")
    sub = p.add_subparsers(dest="cmd", required=True)

    a = sub.add_parser("prepare", help="QA sources -> train/val JSONL + metadata")
    a.add_argument("--tables-dir", required=True, help="directory holding the source tables")
    a.add_argument("--out-dir", default="data")
    a.add_argument("--train-size", type=int, default=C.DEFAULT_TRAIN_SIZE)
    a.add_argument("--val-fraction", type=float, default=C.DEFAULT_VAL_FRACTION)
    a.add_argument("--include", nargs="+", default=C.DEFAULT_INCLUDE, choices=C.DEFAULT_INCLUDE)
    a.add_argument("--seed", type=int, default=C.DEFAULT_SEED)

    b = sub.add_parser("pretokenize", help="JSONL -> window-cropped, masked token rows")
    b.add_argument("--train_file", default="data/train.jsonl")
    b.add_argument("--val_file", default="data/val.jsonl")
    b.add_argument("--out_dir", default="data")
    b.add_argument("--max_length", type=int, default=C.WINDOW_MAX_LENGTH)
    b.add_argument("--tokenizer_file", default=None, help="a tokenizers JSON file (default: stand-in)")

    c = sub.add_parser("batches", help="raw or tokenized split -> padded batches (Parquet)")
    c.add_argument("--train_dir", default=None)
    c.add_argument("--train_file", default=None)
    c.add_argument("--out_dir", required=True)
    c.add_argument("--max_seq_length", type=int, default=C.RAW_MAX_LENGTH)
    c.add_argument("--max_train_samples", type=int, default=None)
    c.add_argument("--eval_dir", default=None)
    c.add_argument("--val_file", default=None)
    c.add_argument("--max_eval_samples", type=int, default=None)
    c.add_argument("--per_device_train_batch_size", type=int, default=C.TRAIN_BATCH_SIZE)
    c.add_argument("--per_device_eval_batch_size", type=int, default=C.EVAL_BATCH_SIZE)
    c.add_argument("--no_mixed_precision", action="store_true")
    c.add_argument("--tokenizer_file", default=None)

    args = p.parse_args(argv)
    from pyspark.sql import SparkSession
    spark = SparkSession.builder.appName(f"chatmill-{args.cmd}").getOrCreate()
    from chatmill.operators.encode import SubwordTokenizer, Tokenizer

    def tokenizer():
        f = getattr(args, "tokenizer_file", None)
        return SubwordTokenizer(f).ship(spark) if f else Tokenizer()

    if args.cmd == "prepare":
        from chatmill.plans.prepare import prepare
        meta = prepare(spark, args.tables_dir, args.out_dir, args.include, args.train_size,
                       args.val_fraction, args.seed)
        print(json.dumps(meta, indent=2, ensure_ascii=False))
    elif args.cmd == "pretokenize":
        from chatmill.plans.pretokenize import pretokenize
        print(pretokenize(spark, args.train_file, args.val_file, args.out_dir, tokenizer(), args.max_length))
    else:
        from chatmill.plans import train_data as TD
        tok = tokenizer()
        (origin, train), evald = TD.load_datasets(spark, train_dir=args.train_dir, train_file=args.train_file,
                                                  eval_dir=args.eval_dir, eval_file=args.val_file, tok=tok,
                                                  max_length=args.max_seq_length,
                                                  max_train_samples=args.max_train_samples,
                                                  max_eval_samples=args.max_eval_samples)
        out = args.out_dir.rstrip("/")
        mixed = not args.no_mixed_precision
        TD.write_batches(TD.collate(train, tok, args.per_device_train_batch_size, mixed), f"{out}/train_batches")
        print(f"train ({origin}) -> {out}/train_batches")
        if evald is not None:
            TD.write_batches(TD.collate(evald[1], tok, args.per_device_eval_batch_size, mixed), f"{out}/eval_batches")
            print(f"eval ({evald[0]}) -> {out}/eval_batches")


if __name__ == "__main__":
    main()
