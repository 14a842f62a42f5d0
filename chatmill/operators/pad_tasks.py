"""X4, task side: rows that lie together in a scan are padded as they pass.

A batch is whole in a task if all its rows pass there one after the other.
Others, cut by the edge of a file or of a scan's split, take their width from
elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Padded ids of rows that are built at a time.
HELD_IDS = 1 << 20


def _segments(ordinals: np.ndarray, batch_size: int) -> np.ndarray:
    """Where runs of consecutive rows of one batch begin, and the end."""
    batch = ordinals // batch_size
    new = np.flatnonzero((np.diff(batch) != 0) | (np.diff(ordinals) != 1)) + 1
    return np.concatenate([[0], new, [len(ordinals)]])


def _whole_runs(batches: Iterator[pa.RecordBatch], batch_size: int, at: int) -> Iterator[pa.RecordBatch]:
    """Record batches that end where a run does; ``at``: the ordinal's column."""
    held = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        batch = pa.concat_batches([held, batch]) if held is not None else batch
        last = int(_segments(batch.column(at).to_numpy(zero_copy_only=False), batch_size)[-2])
        if last:
            yield batch.slice(0, last)
        held = batch.slice(last)
    if held is not None:
        yield held


def edge_finder(batch_size: int):
    """(ordinal, n) in scan order -> (batch_id, width) of what a task holds of
    batches that are not whole in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_runs(batches, batch_size, 0):
            ordinals, n = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            cuts = _segments(ordinals, batch_size)
            cut_off = np.diff(cuts) < batch_size
            widths = np.maximum.reduceat(n, cuts[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(ordinals[cuts[:-1]][cut_off] // batch_size, pa.int64()),
                                              pa.array(widths[cut_off], pa.int32())], ["batch_id", "width"])
    return run


def _pad(lists: pa.ListArray, width: np.ndarray, fill: int) -> tuple[pa.ListArray, np.ndarray]:
    """Lists filled up to their width on the right (longer ones are cut), and their lengths."""
    length = np.minimum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), width).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])
    out = np.full(ends[-1], fill, np.int64)
    begin = lists.offsets.to_numpy()[:-1].astype(np.int64)
    values = lists.values.to_numpy(zero_copy_only=False)
    place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(ends[:-1], length) + place] = values[np.repeat(begin, length) + place]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out)), length


def padder(batch_size: int, pad_id: int, ignore_index: int, multiple: int, n_kept: int):
    """(kept columns, ordinal, input_ids, labels, edge width) -> (kept columns,
    ordinal, batch_id, width, input_ids, attention_mask, labels), in scan order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_runs(batches, batch_size, n_kept):
            ordinals = batch.column(n_kept).to_numpy(zero_copy_only=False)
            ids, labels = batch.column(n_kept + 1), batch.column(n_kept + 2)
            edge = batch.column(n_kept + 3).fill_null(-1).to_numpy(zero_copy_only=False)
            cuts = _segments(ordinals, batch_size)
            widths = np.maximum.reduceat(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), cuts[:-1])
            cut_off = np.diff(cuts) < batch_size
            widths = np.where(cut_off, edge[cuts[:-1]], widths)
            if (widths < 0).any():
                raise RuntimeError("a batch is cut where the first pass found it whole: the scan's splits changed")
            width = np.repeat(-(-widths // multiple) * multiple, np.diff(cuts)).astype(np.int32)
            begin = 0
            while begin < len(width):
                end = begin + max(1, int(np.searchsorted(np.cumsum(width[begin:], dtype=np.int64), HELD_IDS, "right")))
                part, wide = slice(begin, end), width[begin:end]
                p_ids, length = _pad(ids[part], wide, pad_id)
                ends = np.concatenate([[0], np.cumsum(wide, dtype=np.int64)])
                mask = np.zeros(ends[-1], np.int64)
                mask[np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(ends[:-1], length)] = 1
                p_labels, _ = _pad(labels[part], wide, ignore_index)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i)[part] for i in range(n_kept + 1)), pa.array(ordinals[part] // batch_size, pa.int64()), pa.array(wide),
                     p_ids, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(mask)), p_labels],
                    [*batch.schema.names[:n_kept + 1], "batch_id", "width", "input_ids", "attention_mask", "labels"])
                begin = end
    return run
