import gzip
import hashlib
import os

import pytest

from chatmill.llm import warc, warc_records
from chatmill.session import scratch_path


def _member(i, text, ref=None):
    return warc_records.member(i, f"http://x/{i}", text.encode(), hashlib.sha1(text.encode()).hexdigest(), ref)


def _read(data):
    out = list(warc_records.salvage(data))
    return [r["page_id"] for r in out if "gap" not in r], [r["gap"] for r in out if "gap" in r]


def test_salvage_of_damaged_archives():
    a, b, c = (_member(i, f"page {i} " * 50) for i in range(3))
    sep = warc_records.EMPTY_MEMBER
    assert gzip.decompress(a + sep + b + sep).count(b"WARC/1.1\r\n") == 2
    assert _read(a + sep + b + sep + c + sep) == ([0, 1, 2], [])
    broken = bytearray(b)
    broken[len(b) // 2] ^= 0xFF
    assert _read(a + bytes(broken) + c) == ([0, 2], [(len(a), len(a) + len(b))])
    assert _read(a + b[:40] + c) == ([0, 2], [(len(a), len(a) + 40)])
    begin = 4 + len(a) + 6                                       # of the last one, which is kept though its end is missing
    assert _read(b"junk" + a + b"\x1f\x8b\x08 no" + c[:-3]) == ([0, 2], [(0, 4), (begin - 6, begin), (begin, begin + len(c) - 3)])
    assert _read(b"") == ([], []) and _read(b"junk") == ([], [(0, 4)])
    plain = [gzip.decompress(x) for x in (a, b, c)]
    assert _read(b"".join(plain)) == ([0, 1, 2], [])
    wrong = plain[1].replace(b"page 1", b"page 7", 1)            # a digest no longer fits
    assert _read(plain[0] + wrong + plain[2]) == ([0, 2], [(len(plain[0]), len(plain[0]) + len(wrong))])
    longer = plain[1].replace(b"Content-Length: 4", b"Content-Length: 9", 1)
    assert _read(plain[0] + longer + c)[0] == [0, 2]


def _inner(data):
    out = list(warc_records.salvage(data))
    return [r["page_id"] for r in out if "gap" not in r], [(r["gap"], r["inner"]) for r in out if "gap" in r]


def test_salvage_within_a_member():
    """One gzip member of 50 records: a bad digest, a cut end and a damaged middle cost only what they touch."""
    plain = [gzip.decompress(_member(i, f"page {i} " * 40)) for i in range(50)]
    after = _member(99, "after " * 30)
    whole = gzip.compress(b"".join(plain))
    assert _inner(whole + after) == ([*range(50), 99], [])
    bad = list(plain)
    bad[20] = bad[20].replace(b"page 20", b"page 2X", 1)
    one = gzip.compress(b"".join(bad))
    begin = sum(map(len, bad[:20]))
    assert _inner(one + after) == ([i for i in [*range(50), 99] if i != 20], [((0, len(one)), (begin, begin + len(bad[20])))])
    for cut in (whole[:-8], whole[:-1], whole[:len(whole) * 2 // 3]):
        ids, gaps = _inner(cut)
        assert ids == list(range(len(ids))) and len(ids) >= (49 if len(cut) > len(whole) - 9 else 20) and [g[0] for g in gaps][0] == (0, len(cut))
    noise = bytearray(gzip.compress(b"".join(plain), 1))
    noise[len(noise) // 2:len(noise) // 2 + 40] = b"\xff" * 40
    ids, gaps = _inner(bytes(noise) + after)
    assert ids[-1] == 99 and len(ids) >= 10 and len(ids) == len(set(ids)) and gaps
    stored = gzip.compress(b"".join(plain), 0)[:-12] + b"x" * 12        # stored blocks show their version lines to a search
    ids, _ = _inner(stored + after)
    assert ids == [*range(len(ids) - 1), 99] and len(ids) >= 50


def test_long_urls(spark):
    rows = [(1, "http://x/" + "u" * (3 << 20), "page"), (2, "http://y", "other")]
    path = scratch_path(spark, "test-warc")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    records, gaps = warc.read_warc(spark, path, strict=True)
    assert sorted((r.page_id, len(r.url)) for r in records.collect()) == [(1, len(rows[0][1])), (2, 8)] and gaps.count() == 0
    with pytest.raises(ValueError):
        warc_records.member(1, "u" * (17 << 20), b"", "", None)


def test_a_gap_is_an_error_when_strict(spark):
    path = scratch_path(spark, "test-warc").removeprefix("file:")
    os.makedirs(path)
    with open(f"{path}/a.warc.gz", "wb") as f:
        f.write(_member(1, "one") + b"junk" + _member(2, "two"))
    records, gaps = warc.read_warc(spark, path)
    assert records.count() == 2 and [(r.gap_end - r.gap_start, r.inner_start) for r in gaps.collect()] == [(4, None)]
    with pytest.raises(Exception, match="belong to no record"):
        warc.read_warc(spark, path, strict=True)[0].select("page_id").collect()


def test_written_bytes_are_gzip_members(spark):
    """Spark's text writer passes the bytes on as they are."""
    path = scratch_path(spark, "test-warc")
    rows = [(i, "u", "".join(map(chr, range(1, 700))) * (i + 1)) for i in range(20)]
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    contents = [r.content for r in spark.read.format("binaryFile").load(path).collect()]
    assert gzip.decompress(b"".join(contents)).count(b"WARC-Record-ID") == 20


def test_round_trip(spark):
    long, mid = "é" * 600, "x" * 999
    rows = [(1, "http://a", long), (9, "http://b\r\nevil: 1", long), (5, None, long), (2, "u", mid), (3, "u", mid), (4, "u", None), (6, "u", ""),
            (7, "u", "WARC/1.1\r\n" * 200), (8, "u", "\x00\x1f\r\n\r\n" * 300), (9, "again", long), (None, "n", long), (10, "u", "big " * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS first", "3 AS payload")
    path = scratch_path(spark, "test-warc")
    warc.write_warc(pages, path)
    records, gaps = warc.read_warc(spark, path)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records.collect()), key=str)
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        first = 9 if h == long else i
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if first == i else "revisit", None if first == i else first))
    assert got == sorted(want, key=str) and gaps.count() == 0
    payloads = {r.page_id: r.payload for r in records.where("record_type = 'response'").collect()}
    assert payloads[8] == rows[8][2].encode() and payloads[4] == b""
    empty = scratch_path(spark, "test-warc")
    warc.write_warc(pages.where("false"), empty)
    assert warc.read_warc(spark, empty)[0].count() == 0
