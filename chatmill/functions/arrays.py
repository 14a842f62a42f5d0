"""Sub-array search, label masking, truncation and padding.

All are built-in array expressions without lambdas, so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatmill.config import IGNORE_INDEX
from chatmill.functions.text import _c


def find_subarray(haystack, needle: Sequence[int]) -> Column:
    """0-based position of the first occurrence of ``needle``; -1 when absent,
    when the needle is empty or longer than the haystack, or on null (C3).

    m = 1 is ``array_position``. For m > 1 the haystack is zipped with its
    m-1 shifted copies and the needle is looked up as one struct; the zip's
    null padding at the tail can never equal the needle.
    """
    h = _c(haystack)
    m = len(needle)
    if m == 0:
        return F.lit(-1)
    if m == 1:
        found = F.array_position(h, F.lit(int(needle[0])))
    else:
        n = F.size(h)
        shifted = [F.slice(h, i + 1, n) for i in range(m)]   # all unnamed -> fields "0".."m-1"
        probe = F.struct(*[F.lit(int(v)).alias(str(i)) for i, v in enumerate(needle)])
        found = F.array_position(F.arrays_zip(*shifted), probe)
    return F.coalesce(found.cast("int") - 1, F.lit(-1))


def count_subarray(haystack, needle: Sequence[int]) -> Column:
    """How often ``needle`` occurs, overlaps counted; 0 when it is empty or
    longer than the haystack, or on null. The zip of ``find_subarray``, less
    what is left of it without the needle."""
    h = _c(haystack)
    m = len(needle)
    if m == 0:
        return F.lit(0)
    if m == 1:
        zipped, probe = h, F.lit(int(needle[0]))
    else:
        n = F.size(h)
        zipped = F.arrays_zip(*[F.slice(h, i + 1, n) for i in range(m)])
        probe = F.struct(*[F.lit(int(v)).alias(str(i)) for i, v in enumerate(needle)])
    return F.when(h.isNull(), F.lit(0)).otherwise(F.size(zipped) - F.size(F.array_remove(zipped, probe)))


def mask_prefix(ids, upto, ignore_index: int = IGNORE_INDEX) -> Column:
    """Copy of ``ids`` with the first ``upto`` entries set to -100."""
    ids, upto = _c(ids), _c(upto).cast("int")
    return F.concat(
        F.array_repeat(F.lit(ignore_index), upto),
        F.slice(ids, upto + 1, F.greatest(F.size(ids) - upto, F.lit(0))),
    )


def mask_labels_keep(ids, pos, marker_len: int, enabled: bool = True,
                     ignore_index: int = IGNORE_INDEX) -> Column:
    """Raw-path labels: mask through the marker when it was found, else keep
    every token supervised; ``enabled=False`` disables masking (C6)."""
    ids, pos = _c(ids), _c(pos)
    if not enabled:
        return ids
    return F.when(pos < 0, ids).otherwise(mask_prefix(ids, pos + F.lit(marker_len), ignore_index))


def truncate_head(ids, max_length: int) -> Column:
    """Keep the first ``max_length`` ids."""
    return F.slice(_c(ids), 1, F.lit(int(max_length)))


def pad_right(arr, width, value: int) -> Column:
    """Right-pad ``arr`` with ``value`` to ``width``; longer input is cut."""
    arr, width = _c(arr), _c(width).cast("int")
    return F.slice(
        F.concat(arr, F.array_repeat(F.lit(int(value)), F.greatest(width - F.size(arr), F.lit(0)))),
        1, width,
    )


def window_start(ids, pos, marker_len: int, max_len: int, min_answer: int) -> Column:
    """Start offset of the admissible window around the marker, or null when
    there is none (C4, F4, F7).

    Closed form of the two tries: the window always starts at or before the
    first marker, so a search inside it can only find the marker at
    ``pos - start`` (or miss it when the marker overruns the window end).
    """
    ids, pos = _c(ids), _c(pos)
    m, L, k = int(marker_len), int(max_len), int(min_answer)
    n = F.size(ids)
    w = F.least(n, F.lit(L))
    lead = max(m + 1, L // 4)
    start1 = F.when(n <= L, F.lit(0)).otherwise(
        F.greatest(F.lit(0), F.least(pos - F.lit(lead), n - F.lit(L))))
    start2 = F.greatest(F.lit(0), F.least(pos - F.lit(1), n - F.lit(L)))

    def ok(s):
        rel = pos - s
        return (pos >= 0) & (rel + F.lit(m) <= w) & (w - rel - F.lit(m) >= F.lit(k))

    return F.when(ok(start1), start1).when((n > L) & ok(start2), start2)
