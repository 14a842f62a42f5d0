"""WARC archives of web pages, and a reader that salvages damaged ones.

Archives are written by Spark's text writer, so on any file system it knows: a
line is a record, one gzip member, and the line separator is an empty gzip
member. A file is thus a plain series of members, as other tools expect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import warc_records
from .common import ship

#: A file is read as one row; this bounds it.
RECORDS_PER_FILE = 2_000
#: Payloads of fewer bytes are always stored.
LEAST_SHARED = 1_000


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write one record a row. Of equal payloads of at least 1,000 bytes the row
    of the largest id is a response, the others are revisits of it; smaller
    payloads are all responses.

    A null html is the empty payload; a null url gives no target. A null id is
    never the one revisited while another row has an id, and reads back as
    null. Rows that share the largest id are all responses. Ids are cast to
    long. A url that makes a header too long to be read back raises an error;
    payloads may be of any size. Other columns are not read. Only digests are
    grouped; the few that repeat are joined back.
    """
    ship(warc_records.__name__)
    raw = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), F.sha1(raw).alias("digest"))
    digests = pages.select(F.col(id_col).cast("long").alias("page_id"), F.sha1(raw).alias("digest"), F.octet_length(raw).alias("n")).where(F.col("n") >= LEAST_SHARED)
    repeated = digests.groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    placed = rows.join(repeated, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))
    members = placed.mapInArrow(warc_records.writer, "member binary").select(F.col("member").cast("string").alias("value"))
    (members.write.option("maxRecordsPerFile", RECORDS_PER_FILE).option("encoding", "ISO-8859-1")
     .option("lineSep", warc_records.EMPTY_MEMBER.decode("latin-1")).text(path))


def read_warc(spark: SparkSession, path: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """The records (page_id, url, record_type, payload_bytes, payload_digest,
    refers_to, payload) of all archives under ``path``, and the quarantined
    gaps (file, gap_start, gap_end: byte offsets in the file; inner_start,
    inner_end: within what a member of that extent decompresses to, if it can
    be read there). With ``strict``, a gap is an error when records are read.

    An empty payload is an empty binary; a revisit has none. A file is one row:
    Spark reads no archive of more than 2 GB.
    """
    ship(warc_records.__name__)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    read = files.mapInArrow(warc_records.reader, warc_records.FIELDS)
    gap = ["file", "gap_start", "gap_end", "inner_start", "inner_end"]
    whole = F.col("gap_start").isNull()
    if strict:
        whole = F.when(whole, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("bytes that belong to no record: "), F.col("file"), F.lit(" from "), F.col("gap_start").cast("string"))).cast("boolean"))
    return read.where(whole).drop(*gap), read.where(F.col("gap_start").isNotNull()).select(*gap)


#: DuckDB: what a correct round trip returns.
SQL = """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS d, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
 r AS (SELECT d, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
 CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN r ON p.d = r.d AND p.n >= 1000
"""
