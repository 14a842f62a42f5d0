"""X2, X2r, C4-C7, F4-F7, A3: token ids, window cropping, label masking.

Both tokenizing paths are narrow, shuffle-free projections:

* window path (``tokenize_and_mask``): text -> ids -> first marker ->
  window around it -> labels masked through the marker; rows without an
  admissible window are dropped (F4, F7), as are rows with < 8 supervised
  labels (F5).
* raw path (``encode_raw``): ids truncated at the head, labels masked only
  when the marker survives; rows with < 8 supervised labels are dropped.

The marker position is computed once in a projection and rows are emitted
through ``inline`` (0 or 1 row each). Filtering on the computed position
instead would let the optimizer push the predicate below the projection
and evaluate the search twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from chatmill.config import (ASSISTANT_MARKER, IGNORE_INDEX, MIN_ANSWER_TOKENS, RAW_MAX_LENGTH, SPECIAL_TOKENS,
                             WINDOW_MAX_LENGTH)
from chatmill.functions import tokens as TK
from chatmill.functions.arrays import count_subarray, find_subarray, mask_labels_keep, mask_prefix, truncate_head, window_start
from chatmill.functions.templates import build_text
from chatmill.sources.schemas import TOKENIZED


@dataclass(frozen=True)
class Tokenizer:
    """The stand-in tokenizer: specials first, hashed ids for the rest."""
    specials: tuple = tuple(SPECIAL_TOKENS)
    buckets: int = TK.DEFAULT_BUCKETS
    marker: str = ASSISTANT_MARKER
    pad_id: int | None = None          # None -> falls back to the end marker's id (eos)
    extra: dict = field(default_factory=dict)

    def tokens(self, text) -> Column:
        return TK.split_tokens(text, self.specials)

    def ids(self, text) -> Column:
        return TK.text_to_ids(text, self.specials, self.buckets)

    def encode_py(self, text: str) -> list[int]:
        return TK.py_encode(text, self.specials, self.buckets)

    @property
    def marker_ids(self) -> list[int]:
        return self.encode_py(self.marker)

    @property
    def pad_token_id(self) -> int:
        return self.pad_id if self.pad_id is not None else self.encode_py("<|im_end|>")[0]

    def raw_ids(self, text, bos_id: int | None = None) -> Column:
        """Raw-path encode: the stand-in adds no special tokens of its own;
        ``bos_id`` stands for a tokenizer that prepends one."""
        ids = self.ids(text)
        return ids if bos_id is None else F.concat(F.array(F.lit(int(bos_id))), ids)


@dataclass(frozen=True)
class SubwordTokenizer:
    """A ``tokenizers`` JSON file used through an Arrow-batched UDF (the
    reference's pretrained tokenizer slot). Specials are added tokens."""
    path: str
    specials: tuple = tuple(SPECIAL_TOKENS)
    marker: str = ASSISTANT_MARKER
    pad_id: int | None = None

    def ship(self, spark) -> "SubwordTokenizer":
        from chatmill.session import ship_package
        ship_package(spark)
        spark.sparkContext.addFile(self.path)
        return self

    def _tok(self):
        from chatmill.functions.subword import load
        return load(self.path, self.specials)

    def tokens(self, text) -> Column:
        from chatmill.functions.subword import tokens_udf
        return tokens_udf(self.path, self.specials)(F.col(text) if isinstance(text, str) else text)

    def ids(self, text) -> Column:
        from chatmill.functions.subword import encode_column
        return encode_column(text, self.path, self.specials, add_special_tokens=False)

    def raw_ids(self, text, bos_id: int | None = None) -> Column:
        """Raw path: the library default, i.e. with the tokenizer's own
        post-processing (BOS/EOS) when it defines one."""
        from chatmill.functions.subword import encode_column
        ids = encode_column(text, self.path, self.specials, add_special_tokens=True)
        return ids if bos_id is None else F.concat(F.array(F.lit(int(bos_id))), ids)

    def encode_py(self, text: str) -> list[int]:
        return list(self._tok().encode(text, add_special_tokens=False).ids)

    @property
    def marker_ids(self) -> list[int]:
        return self.encode_py(self.marker)

    @property
    def pad_token_id(self) -> int:
        if self.pad_id is not None:
            return self.pad_id
        tok = self._tok()
        return tok.token_to_id("<|im_end|>")


def text_ids(df: DataFrame, tok: Tokenizer = Tokenizer(), keep=(), name: str = "input_ids") -> DataFrame:
    """instruction/output -> joined text (J7) -> ids, no special tokens added."""
    return df.select(*keep, tok.ids(build_text("instruction", "output")).alias(name))


def _emit(ok: Column, ids: Column, labels: Column) -> Column:
    row = F.struct(ids.alias("input_ids"), F.array_repeat(F.lit(1), F.size(ids)).alias("attention_mask"),
                   labels.alias("labels"))
    return F.inline(F.when(ok, F.array(row)).otherwise(F.array().cast(ArrayType(TOKENIZED))))


def window_and_mask(ids_df: DataFrame, marker_ids, max_length: int = WINDOW_MAX_LENGTH,
                    min_answer: int = MIN_ANSWER_TOKENS, keep=(), ids: str = "input_ids") -> DataFrame:
    """C3 + C4 + C5 + F4/F5/F7 on an ids column.

    Staged projections (position, then window start, then window and mask
    length, then the emit) keep every generated method small enough for the
    JIT; one nested expression repeats the start arithmetic at each use.
    """
    m = len(marker_ids)
    x = ids_df.select(*keep, F.col(ids).alias("_ids"), find_subarray(F.col(ids), marker_ids).alias("_pos"))
    x = x.select(*keep, "_ids", "_pos", window_start("_ids", "_pos", m, max_length, min_answer).alias("_start"))
    x = x.select(*keep, F.slice("_ids", F.col("_start") + 1, F.least(F.size("_ids"), F.lit(int(max_length)))).alias("_win"),
                 (F.col("_pos") - F.col("_start") + F.lit(m)).alias("_upto"))
    ok = F.col("_win").isNotNull() & (F.size("_win") - F.col("_upto") >= F.lit(MIN_ANSWER_TOKENS))
    return x.select(*keep, _emit(ok, F.col("_win"), mask_prefix("_win", "_upto")))


def tokenize_and_mask(df: DataFrame, tok: Tokenizer = Tokenizer(), max_length: int = WINDOW_MAX_LENGTH,
                      min_answer: int = MIN_ANSWER_TOKENS, keep=()) -> DataFrame:
    """Window path of one record set (K): rows of (input_ids, attention_mask, labels)."""
    return window_and_mask(text_ids(df, tok, keep, "_text_ids"), tok.marker_ids, max_length, min_answer,
                           keep, "_text_ids")


def encode_raw(df: DataFrame, tok: Tokenizer = Tokenizer(), max_length: int | Sequence[int] = RAW_MAX_LENGTH,
               bos_id: int | None = None, mask: bool = True, keep=()) -> DataFrame:
    """Raw path (T): head truncation, marker-optional masking, >= 8 supervised.
    Of several lengths, each gives its rows, with a column ``max_length``; a
    text is encoded once for all."""
    several = not isinstance(max_length, int)
    ids = tok.raw_ids(build_text("instruction", "output"), bos_id)
    marker = tok.marker_ids
    m = len(marker)
    x = df.select(*keep, truncate_head(ids, max(max_length) if several else max_length).alias("_ids"))
    if several:
        x = x.select(*keep, "_ids", F.explode(F.array(*[F.lit(int(n)) for n in max_length])).alias("max_length"))
        keep = [*keep, "max_length"]
        x = x.select(*keep, F.slice("_ids", F.lit(1), F.col("max_length")).alias("_ids"))
    x = x.select(*keep, "_ids", find_subarray("_ids", marker).alias("_pos"))
    n = F.size("_ids")
    supervised = n if not mask else F.when(F.col("_pos") < 0, n).otherwise(n - F.col("_pos") - F.lit(m))
    x = x.select(*keep, "_ids", mask_labels_keep("_ids", "_pos", m, mask, IGNORE_INDEX).alias("_labels"),
                 (supervised >= F.lit(MIN_ANSWER_TOKENS)).alias("_ok"))
    return x.select(*keep, _emit(F.col("_ok"), F.col("_ids"), F.col("_labels")))


def filter_nonempty(df: DataFrame) -> DataFrame:
    """keep rows whose ``input_ids`` is present and non-empty."""
    return df.where(F.coalesce(F.size("input_ids"), F.lit(0)) > 0)


def supervised_tokens(df: DataFrame, name: str = "n_supervised") -> DataFrame:
    """A3: per-row count of labels that are not -100."""
    return df.withColumn(name, F.size(F.array_remove("labels", F.lit(IGNORE_INDEX))).cast("long"))


def marker_counts(df: DataFrame, marker_ids, name: str = "n_markers", ids: str = "input_ids") -> DataFrame:
    """Appends how often the marker occurs in the ids, overlaps counted. The
    mask begins at the first one, so a text with more has a marker in its labels."""
    return df.withColumn(name, count_subarray(ids, marker_ids).cast("long"))


def marker_tally(df: DataFrame, marker_ids, by=(), ids: str = "input_ids") -> DataFrame:
    """A histogram of rows by their number of markers, within groups ``by``:
    n_markers, n_rows. Summed up before the exchange, of a row a group and number.
    Of several markers (name -> ids), each has its own, told by a column
    ``needle``; a row's ids are computed once for all."""
    if not isinstance(marker_ids, Mapping):
        counted = marker_counts(df.select(*by, ids), marker_ids, ids=ids)
        return counted.groupBy(*by, "n_markers").agg(F.count(F.lit(1)).alias("n_rows"))
    counts = [F.struct(F.lit(name).alias("needle"), count_subarray(ids, needle).cast("long").alias("n_markers")) for name, needle in marker_ids.items()]
    counted = df.select(*by, ids).select(*by, F.inline(F.array(*counts)))
    return counted.groupBy("needle", *by, "n_markers").agg(F.count(F.lit(1)).alias("n_rows"))
