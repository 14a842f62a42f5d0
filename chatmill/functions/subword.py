"""Plug-in subword tokenizer (a ``tokenizers`` JSON file) as an Arrow-batched
pandas UDF.

The file is shipped with ``SparkContext.addFile`` and loaded once per
Python worker; the special literals are registered as added tokens so each
stays one token wherever it occurs. Only the per-batch encode runs in
Python; windowing, masking and batching stay JVM-side.
"""

from __future__ import annotations

import os
import sys
import types
from collections.abc import Sequence

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.config import SPECIAL_TOKENS

def _loaded() -> dict:
    """This process' tokenizers. They live outside this module, which travels
    to the workers by value: what the driver has loaded stays there."""
    return sys.modules.setdefault("_chatmill_tokenizers", types.ModuleType("_chatmill_tokenizers")).__dict__.setdefault("loaded", {})


def load(path: str, specials: Sequence[str] = SPECIAL_TOKENS):
    """The tokenizer of a file, with the special literals as added tokens."""
    key, loaded = (path, tuple(specials)), _loaded()
    if key not in loaded:
        from tokenizers import AddedToken, Tokenizer
        tok = Tokenizer.from_file(path)
        tok.add_special_tokens([AddedToken(s, special=True, normalized=False) for s in specials])
        loaded[key] = tok
    return loaded[key]


def _local_path(name: str, fallback: str) -> str:
    try:
        p = SparkFiles.get(name)
        if os.path.exists(p):
            return p
    except Exception:
        pass
    return fallback


def encode_udf(path: str, specials: Sequence[str] = SPECIAL_TOKENS, add_special_tokens: bool = False):
    """pandas UDF: STRING -> ARRAY<INT> with the given tokenizer file."""
    name, specials = os.path.basename(path), list(specials)

    @F.pandas_udf(T.ArrayType(T.IntegerType(), containsNull=False))
    def encode(texts: pd.Series) -> pd.Series:
        tok = load(_local_path(name, path), specials)
        encs = tok.encode_batch(texts.fillna("").tolist(), add_special_tokens=add_special_tokens)
        return pd.Series([e.ids for e in encs])

    return encode


def tokens_udf(path: str, specials: Sequence[str] = SPECIAL_TOKENS):
    """pandas UDF: STRING -> ARRAY<STRING> token strings."""
    name, specials = os.path.basename(path), list(specials)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def tokens(texts: pd.Series) -> pd.Series:
        tok = load(_local_path(name, path), specials)
        return pd.Series([e.tokens for e in tok.encode_batch(texts.fillna("").tolist(), add_special_tokens=False)])

    return tokens


def encode_column(text, path: str, specials: Sequence[str] = SPECIAL_TOKENS, add_special_tokens: bool = False) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return encode_udf(path, specials, add_special_tokens)(c)
