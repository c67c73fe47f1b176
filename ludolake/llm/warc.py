"""WARC archives: written by Spark, read back by boundary-chain verification.

*Writing.* Records of equal payloads are found by digest; the one with the
smallest page id is a ``response``, the others are ``revisit`` records that
name it and repeat its digest and length but not its payload. Payloads shorter
than a bound are always responses. Every record becomes one row, and Spark's
text writer puts the rows of a task one after another into a file: the last
line feed of the record's end is the writer's line separator. So writing is
committed, retried and stored like any other table. Files are
gzip-compressed; offsets are those of the plain content.

*Reading.* ``WARC/1.1`` may well stand inside a payload, so finding it proves
nothing. Tasks read archives and emit, for every place in a file that looks
like a record's head, that offset and the offset of its successor (head and
stated length). A record is real if it can be reached from the file's start.
That is found for all files at once by pointer jumping: in round i every
offset knows the one 2**i records on, and every offset reached hands on to
that one; after log2(records of a file) rounds all are reached. Only then are
the reached records parsed, and their payloads' digests verified.

The size of a file is bounded by the writer (``FILE_BYTES`` of payload and one
record more); one file is what a reading task holds.

Defined cases: null html is an empty payload, null url leaves the target line
out; control characters in a url are percent-encoded. Every row is a record, and
a payload has one response: of the rows with the smallest id (null last) the one
with the smallest url (null last), and of rows that are equal in that, too, any
one. All others revisit it, also those with its id; a response without an id is
referred to by null. Urls and payloads may be of any length. A chain that ends
before the end of its file, or a digest that doesn't match, raises an error.
Other columns don't matter, whatever their names. Empty table: no file, empty
result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import re
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as Wd
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import column, cut

MAGIC = b"WARC/1.1\r\n"
FILE_BYTES = 8 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def digest32(payload: Column) -> Column:
    """Base-32 SHA-1 of a binary column: 160 bits as 32 letters of five."""
    bits = F.concat(*(F.lpad(F.conv(F.substring(F.sha1(payload), i, 10), 16, 2), 40, "0")
                      for i in range(1, 41, 10)))
    letters = ", ".join(f"'{c}'" for c in _ALPHABET)
    return F.transform(F.array(bits), lambda b: F.array_join(F.transform(
        F.sequence(F.lit(0), F.lit(31)),
        lambda i: F.element_at(F.expr(f"array({letters})"),
                               F.conv(F.substring(b, i * 5 + 1, F.lit(5)), 2, 10).cast("int") + 1)), ""))[0]


def plan_records(pages: DataFrame, files: int, page_id: str = "page_id", url: str = "url",
                 html: str = "html", min_bytes: int = 0) -> DataFrame:
    """Every page with its payload's digest and what kind of record it gets
    (``revisit``, ``refers_to``), in one partition for each file."""
    rows = pages.select(column(page_id).cast("long").alias("page_id"), column(url).alias("url"),
                        F.coalesce(column(html), F.lit("")).alias("html"))
    rows = rows.withColumn("payload_bytes", F.octet_length("html").cast("long"))
    rows = rows.withColumn("payload_digest", digest32(F.col("html").cast("binary")))
    # Names a row up to exact copies with the payload; never null, sorts by id
    # (null last), then url (null last).
    shifted = F.lpad((F.col("page_id").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    rows = rows.withColumn("who", F.concat(F.coalesce(shifted, F.lit("~")), F.coalesce(
        F.concat(F.lit(" "), F.col("url")), F.lit("~"))))
    # Sums before the shuffle, so copies cost little.
    kinds = cut(rows.select("page_id", "who", "payload_digest", "payload_bytes"))
    payload = ["payload_digest", "payload_bytes"]
    first = (kinds.filter(F.col("payload_bytes") >= min_bytes).groupBy(payload)
             .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("who", "page_id")).alias("first"))
             .filter("n > 1").select(*payload, "first"))
    # Only repeated payloads are looked up; a frequent one is split by AQE.
    repeated = (kinds.join(first, payload)
                .select("who", "payload_digest", F.col("first.page_id").alias("first_id"),
                        (F.col("who") == F.col("first.who")).alias("is_first")).distinct())
    # Dealt out once, by what the lookup needs and into as many files as wanted.
    planned = rows.repartition(files, "who", "payload_digest").join(repeated, ["who", "payload_digest"], "left")
    # Of rows that are equal in all of this, one is the response; they are in
    # one partition already.
    nth = F.row_number().over(Wd.partitionBy("who", "payload_digest").orderBy("who"))
    revisit = F.col("is_first").isNotNull() & (~F.col("is_first") | (nth > 1))
    return (planned.withColumn("revisit", F.coalesce(revisit, F.lit(False)))
            .withColumn("refers_to", F.when(F.col("revisit"), F.col("first_id"))).drop("who", "is_first", "first_id"))


def _record(columns: DataFrame) -> DataFrame:
    """The text of each record, without its very last line feed."""
    uri = F.col("url")
    for code in (*range(0x21), 0x7F):
        uri = F.replace(uri, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    end = "\r\n"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{end}Content-Type: text/html; charset=utf-8{end}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(end + end))
    revisit = F.col("revisit")
    refers = F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.coalesce(F.col("refers_to").cast("string"), F.lit("")),
                      F.lit(f">{end}WARC-Profile: {PROFILE}{end}X-Payload-Length: "),
                      F.col("payload_bytes").cast("string"), F.lit(end))
    head = F.concat(
        F.lit(MAGIC.decode()), F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit(end),
        F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(f">{end}"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), uri, F.lit(end)), F.lit("")),
        F.lit(f"WARC-Date: {_DATE}{end}"),
        F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest"), F.lit(end),
        F.when(revisit, refers).otherwise(""),
        F.lit(f"Content-Type: application/http; msgtype=response{end}Content-Length: "))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("html")))
    return columns.select(F.concat(head, F.octet_length(block).cast("string"), F.lit(end + end), block,
                                   F.lit("\r\n\r")).alias("value"))


def write(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES, **columns) -> None:
    """Writes ``pages`` as WARC files of about ``file_bytes`` each. Files are
    filled by hash, so a frequent host or payload is spread over all."""
    size = F.octet_length(F.coalesce(column(columns.get("html", "html")), F.lit(""))) + 600
    total = pages.agg(F.sum(size)).first()[0] or 0
    planned = plan_records(pages, max(1, math.ceil(total / file_bytes)), **columns)
    _record(planned).write.option("lineSep", "\n").option("compression", "gzip").mode("overwrite").text(path)


# -- reading ------------------------------------------------------------------

_LENGTH = re.compile(rb"^Content-Length:[ \t]*(\d+)[ \t]*\r?$", re.IGNORECASE | re.MULTILINE)


def _content(path: str, data: bytes) -> bytes:
    return gzip.decompress(data) if path.endswith(".gz") else data


def _successor(data: bytes, at: int) -> tuple[int, int, int] | None:
    """(start of the block, its length, offset of the next record) of what
    looks like a record at ``at``."""
    end = data.find(b"\r\n\r\n", at)  # a head is as long as its url; files are bounded
    length = _LENGTH.search(data, at, end + 2) if end >= 0 else None
    return _block(data, end, int(length[1])) if length else None


def _block(data: bytes, end: int, n: int) -> tuple[int, int, int] | None:
    after = end + 4 + n
    return (end + 4, n, after + 4) if data[after:after + 4] == b"\r\n\r\n" else None


def _offsets(data: bytes):
    at = data.find(MAGIC)
    end, length = -1, None
    while at >= 0:
        # Starts before the same blank line share its search and its length's.
        if end < at:
            end = data.find(b"\r\n\r\n", at)
            if end < 0:
                return
            length = _LENGTH.search(data, at, end + 2)
        elif length and length.start() < at:
            length = _LENGTH.search(data, at, end + 2)
        if length and (found := _block(data, end, int(length[1]))):
            yield at, found
        at = data.find(MAGIC, at + 1)


def _candidates(batches):
    for batch in batches:
        for path, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
            rows = [(at, found[2]) for at, found in _offsets(_content(path, data))]
            yield pa.record_batch([pa.array([path] * len(rows), pa.string()),
                                   pa.array([a for a, _ in rows], pa.int64()),
                                   pa.array([b for _, b in rows], pa.int64())],
                                  names=["path", "at", "next"])


def reachable(jumps: DataFrame) -> DataFrame:
    """``(path, at)`` of the offsets that a chain of ``(path, at, next)``
    reaches from offset 0, by pointer jumping."""
    jumps = cut(jumps.select("path", "at", "next"))
    reached = cut(jumps.filter("at = 0").select("path", "at"))
    known = -1
    while (count := reached.count()) != known:
        known = count
        handed = reached.join(jumps, ["path", "at"]).select("path", F.col("next").alias("at"))
        reached = cut(reached.union(handed).distinct())
        ahead = jumps.select("path", F.col("at").alias("next"), F.col("next").alias("far"))
        jumps = cut(jumps.join(ahead, ["path", "next"]).select("path", "at", F.col("far").alias("next")))
    return reached


def _field(head: bytes, name: bytes) -> str | None:
    found = re.search(rb"^" + name + rb":[ \t]*(.*?)[ \t]*\r?$", head, re.IGNORECASE | re.MULTILINE)
    return found[1].decode("utf-8", "replace") if found else None


def _page(value: str | None) -> int | None:
    digits = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    return int(digits[1]) if digits else None


_PARSED = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
           "refers_to long, path string, at long, payload binary")


def _parse(files: pa.Table, chain: pa.Table, payloads: bool) -> pa.Table:
    out: dict[str, list] = {f.split()[0]: [] for f in _PARSED.split(", ")}
    for path, data in zip(files["path"].to_pylist(), files["content"].to_pylist()):
        data = _content(path, data)
        end = 0
        for at in sorted(chain["at"].to_pylist()):
            if at >= len(data):  # where the last record's successor would be
                continue
            begin, n, end = _successor(data, at)
            head, block = data[at:begin], data[begin:begin + n]
            kind = _field(head, b"WARC-Type")
            body = block[block.find(b"\r\n\r\n") + 4:]
            stated = (_field(head, b"WARC-Payload-Digest") or "").removeprefix("sha1:")
            if kind == "revisit":
                digest, size = stated, int(_field(head, b"X-Payload-Length") or 0)
            else:
                digest, size = base64.b32encode(hashlib.sha1(body).digest()).decode(), len(body)
                if digest != stated:
                    raise ValueError(f"{path}: the payload at {at} doesn't have the digest it states")
            for name, value in (("page_id", _page(_field(head, b"WARC-Record-ID"))),
                                ("url", _field(head, b"WARC-Target-URI")), ("record_type", kind),
                                ("payload_bytes", size), ("payload_digest", digest),
                                ("refers_to", _page(_field(head, b"WARC-Refers-To"))), ("path", path),
                                ("at", at), ("payload", body if payloads else None)):
                out[name].append(value)
        if end != len(data):
            raise ValueError(f"{path}: the chain of records ends at {end} of {len(data)} bytes")
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.table({f.split()[0]: pa.array(out[f.split()[0]], kinds[f.split()[1]])
                     for f in _PARSED.split(", ")})


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the archives under ``path``."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
             .filter("length > 0").select("path", "content"))
    chain = reachable(files.mapInArrow(_candidates, "path string, at long, next long"))
    return (files.groupBy("path").cogroup(chain.groupBy("path"))
            .applyInArrow(lambda f, c: _parse(f, c, payloads), _PARSED))


def round_trip(pages: DataFrame, min_bytes: int = 0, **columns) -> DataFrame:
    """Writes the pages to the shared folder and reads the archives back; the
    digest columns of every record."""
    spark = pages.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write(pages, path, min_bytes=min_bytes, **columns)
    return read(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages),
h AS (SELECT *, sha1(html) AS hex FROM p),
b AS (
  SELECT *, list_reduce(list_transform(string_split(hex, ''), lambda c: lpad(bin(('0x' || c)::INT), 4, '0')),
    lambda x, y: x || y) AS bits FROM h)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  list_reduce(list_transform(range(0, 32),
    lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      CAST(list_reduce(list_transform(range(1, 6), lambda k: CAST(substr(bits, i * 5 + k, 1) AS INT)),
        lambda x, y: 2 * x + y) AS INT) + 1, 1)), lambda x, y: x || y) AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM b
"""
