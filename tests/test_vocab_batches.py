"""Vocabulary lookup: bounded runs of rows, strings stay in Arrow."""

import pyarrow as pa

from chatmill.operators.vocab import _lookup_fn


class _Broadcast:
    value = (["a", "b", "user"], [8, 9, 6])


def test_runs_are_bounded_and_whole():
    rows = [["a", "b", "zz"] * 10, None, [], ["user", None], ["b"] * 100] * 20
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows, pa.list_(pa.string()))], ["k", "tokens"]).slice(3)
    out = list(_lookup_fn(_Broadcast, "tokens", "ids", -1, 64)([batch]))
    assert len(out) > 20 and all(len(b.column(1).flatten()) <= 100 for b in out)
    known = dict(zip(*_Broadcast.value))
    assert [x for b in out for x in b.column(0).to_pylist()] == list(range(3, len(rows)))
    assert [x for b in out for x in b.column(1).to_pylist()] == [[known.get(t, -1) for t in r or []] for r in rows[3:]]
