"""WARC records: writing members and salvaging archives (task side)."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa

#: Fixed values of the formats.
VERSION = b"WARC/1.1\r\n"
GZIP_MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = b"\x1f\x8b\x08" + b"\0" * 6 + b"\x03\x03" + b"\0" * 9
_START = re.compile(rb"\x1f\x8b\x08|(?:(?<=\n)|\A)WARC/1\.[01]\r\n")
_LINE = re.compile(rb"(?:(?<=\n)|\A)WARC/1\.[01]\r\n")
#: Bytes of a record's header; a longer one (a longer url) is not written.
HEADER_LIMIT = 16 << 20


def member(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """A response or revisit record as one gzip member. A revisit's block is
    the HTTP header, which still tells the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f-\xa0  ]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url))
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    head = VERSION + "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n"
    if len(head) > HEADER_LIMIT:
        raise ValueError(f"page {page_id}: a header of {len(head)} bytes; at most {HEADER_LIMIT} can be read back")
    record = head + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def writer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, url, html, digest, refers_to) -> members."""
    for batch in batches:
        out = [member(p, u, (h or "").encode("utf-8", "surrogatepass"), d, r) for p, u, h, d, r in zip(*(c.to_pylist() for c in batch.columns))]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])


def parse(data: bytes, at: int) -> tuple[dict, int] | None:
    """The record at ``at`` and where it ends, or None if a check fails: the
    version line, the length, the closing lines, both digests."""
    if not data.startswith((b"WARC/1.0\r\n", b"WARC/1.1\r\n"), at):
        return None
    head = data.find(b"\r\n\r\n", at, at + HEADER_LIMIT)
    if head < 0:
        return None
    fields = {}
    for line in data[at:head].split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdigit():
        return None
    begin = head + 4
    end = begin + int(fields["content-length"])
    if data[end:end + 4] != b"\r\n\r\n":
        return None
    block = data[begin:end]
    if "warc-block-digest" in fields and fields["warc-block-digest"].lower() != "sha1:" + hashlib.sha1(block).hexdigest():
        return None
    kind = fields.get("warc-type")
    http, blank, payload = block.partition(b"\r\n\r\n")
    size = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    if kind == "response" and blank:
        digest = hashlib.sha1(payload).hexdigest()
        if fields.get("warc-payload-digest", f"sha1:{digest}").lower() != f"sha1:{digest}":
            return None
        n = len(payload)
    else:
        digest, payload = fields.get("warc-payload-digest", "").lower().removeprefix("sha1:"), None
        n = int(size[1]) if size else None
    number = lambda f: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(f, ""))) else None
    return {"page_id": number("warc-record-id"), "url": fields.get("warc-target-uri"), "record_type": kind, "payload_bytes": n,
            "payload_digest": digest or None, "refers_to": number("warc-refers-to"), "payload": payload}, end + 4


def _unpacked(data: bytes, at: int) -> tuple[bytes, int, bool]:
    """What a gzip member gives before it breaks off, the offset that was read
    up to, and whether it is whole."""
    unpacker, out, begin = zlib.decompressobj(31), [], at
    for step in (1 << 20, 1 << 10, 1):                 # nearer and nearer to the fault
        while begin < len(data) and not unpacker.eof:
            before = unpacker.copy()
            try:
                out.append(unpacker.decompress(memoryview(data)[begin:begin + step]))
            except zlib.error:
                unpacker = before
                break
            begin = min(len(data), begin + step)
        else:
            break
    if unpacker.eof:
        return b"".join(out), begin - len(unpacker.unused_data), True
    return b"".join(out), begin, False


def _records(plain: bytes) -> tuple[list[dict], list[tuple[int, int]]]:
    """The valid records of plain bytes, and the gaps between; after a failed
    check the search goes on at the next version line."""
    records, gaps, at = [], [], 0
    while at < len(plain):
        one, begin = parse(plain, at), at
        while one is None:
            m = _LINE.search(plain, begin + 1)
            begin = m.start() if m else len(plain)
            one = parse(plain, begin) if m else ({}, begin)
        if begin > at:
            gaps.append((at, begin))
        if one[0]:
            records.append(one[0])
        at = one[1]
    return records, gaps


def _at(data: bytes, at: int) -> tuple[list[dict], list[tuple[int, int]], int, bool] | None:
    """The records of the member or the plain record at ``at``, the gaps within
    the member, its end (or how far it can be read), and whether it is whole.
    None if nothing valid begins here."""
    if not data.startswith(GZIP_MAGIC, at):
        one = parse(data, at)
        return one and ([one[0]], [], one[1], True)
    plain, end, whole = _unpacked(data, at)
    records, gaps = _records(plain)
    return (records, gaps, end, whole) if records or (whole and not plain) else None


def salvage(data: bytes) -> Iterator[dict]:
    """The valid records of an archive, and {"gap": (start, end), "inner": ...}
    for what belongs to none: bytes of the file, or with ``inner`` bytes of
    what the member of that extent decompresses to. After a failed check the
    search goes on at the next gzip magic or version line that begins something
    valid, within members too; of a member that is cut or damaged, the records
    before the fault are kept."""
    at = 0
    while at < len(data):
        found = _at(data, at)
        if found and found[3]:
            records, gaps, end, _ = found
            yield from records
            yield from ({"gap": (at, end), "inner": g} for g in gaps)
            at = end
            continue
        begin = found[2] if found else at + 1
        while (m := _START.search(data, begin)) and _at(data, m.start()) is None:
            begin = m.start() + 1
        begin = m.start() if m else len(data)
        if found:
            yield from found[0]
        yield {"gap": (at, begin), "inner": None} if not (found and found[1]) else {"gap": (at, begin), "inner": found[1][0]}
        yield from ({"gap": (at, begin), "inner": g} for g in (found[1][1:] if found else ()))
        at = begin


FIELDS = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary, "
          "file string, gap_start long, gap_end long, inner_start long, inner_end long")


def reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, content) -> records, and gaps with their byte offsets."""
    names = [f.split()[0] for f in FIELDS.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string(), *[pa.int64()] * 4]

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(names, types)], names)

    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            rows: list[dict] = []
            for r in salvage(content.as_py()):
                start, end = r.pop("gap", (None, None))
                inner = r.pop("inner", None) or (None, None)
                rows.append(r | {"file": path.as_py(), "gap_start": start, "gap_end": end, "inner_start": inner[0], "inner_end": inner[1]})
                if len(rows) == 500:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)
