"""Special-aware token splitting and token ids.

The stand-in tokenizer keeps every registered special literal as one token
wherever it occurs (also inside longer words, as an added literal does),
then splits the rest into letter/digit runs and single non-space characters.
Ids: specials take 0..7 in registration order; any other token maps to a
fixed hashed vocabulary of ``buckets`` ids after them, so encoding needs no
lookup table and no shuffle. ``operators.vocab`` offers a fitted vocabulary.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from chatmill.config import SPECIAL_TOKENS
from chatmill.functions.text import _c

DEFAULT_BUCKETS = 1 << 17
SEP = "\x01"   # delimiter wrapped around specials; stripped from input first

# Java and RE2 disagree on whether \s holds U+000B, so the class is spelled out.
_WORD = r"[\p{L}\p{N}]+"
_OTHER = r"[^ \t\n\x0B\f\r\x01]"


def special_pattern(specials: Sequence[str] = SPECIAL_TOKENS) -> str:
    return "(" + "|".join(re.escape(s) for s in specials) + ")"


def _special_search(specials: Sequence[str]) -> str:
    """``special_pattern`` for a scan of whole texts: where no special begins,
    one look at the character tells."""
    first = "".join(sorted({f"\\x{{{ord(s[0]):x}}}" for s in specials if s}))
    return f"(?=[{first}])" + special_pattern(specials) if first and all(specials) else special_pattern(specials)


def token_pattern() -> str:
    return r"\x01[^\x01]+\x01|" + _WORD + "|" + _OTHER


def raw_tokens(text, specials: Sequence[str] = SPECIAL_TOKENS) -> Column:
    """Tokens with each special still wrapped in the delimiter."""
    clean = F.regexp_replace(F.coalesce(_c(text), F.lit("")), F.lit(SEP), F.lit(""))
    wrapped = F.regexp_replace(clean, F.lit(_special_search(specials)), F.lit(SEP + "$1" + SEP))
    return F.regexp_extract_all(wrapped, F.lit(token_pattern()), F.lit(0))


def split_tokens(text, specials: Sequence[str] = SPECIAL_TOKENS) -> Column:
    """Text -> ARRAY<STRING> of tokens."""
    return F.transform(raw_tokens(text, specials), lambda t: F.replace(t, F.lit(SEP), F.lit("")))


def hashed_id(token, n_special: int = len(SPECIAL_TOKENS), buckets: int = DEFAULT_BUCKETS) -> Column:
    """Id of one non-special token: 60 bits of its MD5, modulo ``buckets``. Of
    a power of two, the last digits of the 60 bits tell it."""
    if 0 < buckets <= 1 << 28 and buckets & (buckets - 1) == 0:
        digits = max(1, -(-(buckets.bit_length() - 1) // 4))
        low = F.conv(F.substring(F.md5(_c(token)), 16 - digits, digits), 16, 10).cast("int")
        return (F.lit(n_special) + low.bitwiseAND(F.lit(buckets - 1))).cast("int")
    h60 = F.conv(F.substring(F.md5(_c(token)), 1, 15), 16, 10).cast("long")
    return (F.lit(n_special) + F.pmod(h60, F.lit(buckets))).cast("int")


def token_id(token, specials: Sequence[str] = SPECIAL_TOKENS, buckets: int = DEFAULT_BUCKETS,
             wrapped: bool = False) -> Column:
    """Id of one token; ``wrapped`` matches specials still in delimiters."""
    t = _c(token)
    ids = {SEP + s + SEP if wrapped else s: i for i, s in reversed([*enumerate(specials)])}      # of equal ones the first
    known = F.create_map(*[F.lit(x) for pair in ids.items() for x in pair])
    return F.coalesce(F.try_element_at(known, t), hashed_id(t, len(specials), buckets))


def encode_ids(tokens, specials: Sequence[str] = SPECIAL_TOKENS, buckets: int = DEFAULT_BUCKETS) -> Column:
    """ARRAY<STRING> tokens -> ARRAY<INT> ids."""
    return F.transform(_c(tokens), lambda t: token_id(t, specials, buckets))


def text_to_ids(text, specials: Sequence[str] = SPECIAL_TOKENS, buckets: int = DEFAULT_BUCKETS) -> Column:
    """Text -> ids in one pass over the raw tokens (no delimiter-strip pass:
    only specials carry the delimiter, and they are matched wrapped)."""
    return F.transform(raw_tokens(text, specials), lambda t: token_id(t, specials, buckets, wrapped=True))


# --- driver-side twin, for constants (X3) and brute-force tests -------------
_PY_TOKEN = regex.compile(r"\x01[^\x01]+\x01|[\p{L}\p{N}]+|[^ \t\n\x0B\f\r\x01]")


def py_split_tokens(text: str | None, specials: Sequence[str] = SPECIAL_TOKENS) -> list[str]:
    s = (text or "").replace(SEP, "")
    s = regex.sub(special_pattern(specials), SEP + r"\1" + SEP, s)
    return [t.replace(SEP, "") for t in _PY_TOKEN.findall(s)]


def py_token_id(token: str, specials: Sequence[str] = SPECIAL_TOKENS, buckets: int = DEFAULT_BUCKETS) -> int:
    import hashlib
    if token in specials:
        return list(specials).index(token)
    h60 = int(hashlib.md5(token.encode("utf-8")).hexdigest()[:15], 16)
    return len(specials) + h60 % buckets


def py_encode(text: str, specials: Sequence[str] = SPECIAL_TOKENS, buckets: int = DEFAULT_BUCKETS) -> list[int]:
    """Encode one short string on the driver, e.g. the assistant marker."""
    return [py_token_id(t, specials, buckets) for t in py_split_tokens(text, specials)]
