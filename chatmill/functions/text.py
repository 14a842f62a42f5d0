"""Python-compatible trimming and first-non-empty picks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatmill.config import PY_WHITESPACE


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_trim(c) -> Column:
    """``str.strip()``: trims the 29 Unicode whitespace code points."""
    return F.btrim(_c(c), F.lit(PY_WHITESPACE))


def py_rtrim(c) -> Column:
    """``str.rstrip()``."""
    return F.rtrim(_c(c), F.lit(PY_WHITESPACE))


def clean_text(c) -> Column:
    """``(x or "").strip()``: null-safe trim."""
    return py_trim(F.coalesce(_c(c), F.lit("")))


def first_nonempty(*cols) -> Column:
    """``a or b or ... or ""`` over strings, *before* trimming.

    A whitespace-only value is truthy, so it wins over later keys; the caller
    trims afterwards, so such a value then reads as blank (trap 2).
    """
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols], F.lit(""))
