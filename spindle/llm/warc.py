"""WARC archives from pages, and captures assembled from archives.

``write_archives`` writes, for each page, the records of one transaction:
request, response (or revisit, if an equal payload was captured under a smaller
id) and metadata. The response stands at the centre; request and metadata name
it in WARC-Concurrent-To. The records are ordinary WARC/1.1 with Content-Length
in bytes, each followed by CRLF CRLF, in gzip files that Spark's text sink
writes (the record separator is its line separator). A file is closed after
about ``file_bytes``, so none outgrows what one task can read back.

``read_captures`` reads archives file by file, takes records by Content-Length
(a payload may itself hold lines that look like a record), and assembles
transactions: records are joined through WARC-Concurrent-To, one nested row per
capture (target, response with payload, requests and metadata as arrays). Each
record carries the id of the capture that it belongs to, so the assembly is
one shuffle on that id, and no capture has more records than its own.

Defined cases: a null payload counts as empty; empty payloads are equal to each
other if ``least_bytes`` is 0; of rows with equal id and payload the one with
the smallest url is the response; rows that agree in id, url and payload are
equal records of one capture, counted in n_responses; null ids count as larger
than all others; null urls give an empty target; a request or metadata record whose response is
missing gives a capture without a response; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import on_workers, written

FILE_BYTES = 32 << 20
BROADCAST_ROWS = 100_000
_CRLF = "\r\n"
_HTTP = "application/http;msgtype="


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 40 hex digits as base-32 numbers of 15, 15 and 10 hex digits."""
    h = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(h, at, n), 16, 32), n * 4 // 5, "0") for at, n in ((1, 15), (16, 15), (31, 10))]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _one_line(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), "[\\r\\n]+", " ")


def _record(kind: str, headers: list[tuple[str, Column | str]], body: Column, length: Column) -> Column:
    lines: list[Column] = [F.lit(f"WARC/1.1{_CRLF}WARC-Type: {kind}{_CRLF}")]
    for name, value in headers:
        lines += [F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit(_CRLF)]
    return F.concat(*lines, F.lit("Content-Length: "), length.cast("string"), F.lit(_CRLF * 2), body)


def _first_copies(pages: DataFrame, key: str, url: str, payload: str, least_bytes: int) -> DataFrame:
    """(same, first): of each payload that stands under several rows, the smallest id (and url)."""
    body = F.coalesce(F.col(payload), F.lit(""))
    order = F.struct(F.isnull(key).alias("unnamed"), F.col(key).alias("id"), _one_line(F.col(url)).alias("url"))
    return (pages.where(F.octet_length(body) >= least_bytes).groupBy(F.unhex(F.sha2(body, 256)).alias("same"))
            .agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").select("same", "first"))


def transactions(spark: SparkSession, pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0,
                 broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(records) per page: the strings of its WARC records. Of the payloads that
    stand several times, the table of first copies is broadcast if it has at
    most ``broadcast_rows`` rows (about 100 bytes each) and joined by shuffle
    otherwise, where adaptive execution splits a hot digest."""
    first, _ = written(spark, _first_copies(pages, key, url, payload, least_bytes), "first-copies")
    if first.count() <= broadcast_rows:
        first = F.broadcast(first)
    rows = pages.select(F.col(key).alias("id"), _one_line(F.col(url)).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("body"))
    rows = rows.withColumns({"bytes": F.octet_length("body"), "same": F.unhex(F.sha2("body", 256))}).join(first, "same", "left")
    order = F.struct(F.isnull("id").alias("unnamed"), F.col("id"), F.col("url"))
    revisit = F.col("first").isNotNull() & ~order.eqNullSafe(F.col("first"))

    def uid(kind: str, of: Column, at_url: Column) -> Column:
        return F.concat(F.lit(f"<urn:capture:{kind}:"), F.coalesce(of.cast("string"), F.lit("")), F.lit(":"), F.hex(F.xxhash64(at_url, "same")), F.lit(">"))

    center = uid("response", F.col("id"), F.col("url"))
    digest = F.concat(F.lit("sha1:"), base32_sha1(F.col("body")))
    answer = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(_CRLF * 2))
    asked = F.concat(F.lit("GET "), F.col("url"), F.lit(f" HTTP/1.1{_CRLF}{_CRLF}"))
    told = F.concat(F.lit("page-id: "), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(f"{_CRLF}payload-bytes: "), F.col("bytes").cast("string"), F.lit(_CRLF))
    target = ("WARC-Target-URI", F.col("url"))
    about = [("WARC-Record-ID", center), target, ("WARC-Payload-Digest", digest)]
    response = _record("response", [*about, ("Content-Type", _HTTP + "response")], F.concat(answer, F.col("body")), F.octet_length(answer) + F.col("bytes"))
    again = _record("revisit", [*about, ("WARC-Refers-To", uid("response", F.col("first.id"), F.col("first.url"))),
                                ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("Content-Type", _HTTP + "response")],
                    answer, F.octet_length(answer))
    request = _record("request", [("WARC-Record-ID", uid("request", F.col("id"), F.col("url"))), target, ("WARC-Concurrent-To", center),
                                  ("Content-Type", _HTTP + "request")], asked, F.octet_length(asked))
    metadata = _record("metadata", [("WARC-Record-ID", uid("metadata", F.col("id"), F.col("url"))), target, ("WARC-Concurrent-To", center),
                                    ("Content-Type", "application/warc-fields")], told, F.octet_length(told))
    return rows.select(F.array(request, F.when(revisit, again).otherwise(response), metadata).alias("records"))


def write_archives(spark: SparkSession, pages: DataFrame, path: str, file_bytes: int = FILE_BYTES, **columns) -> None:
    """Write the archives as gzip files of about ``file_bytes`` before compression
    (a file is closed after as many records as have that size on average)."""
    total, rows = pages.agg(F.sum(F.octet_length(columns.get("payload", "html"))), F.count("*")).first()
    per_record = max(1, ((total or 0) / max(rows, 1) + 1500) / 3)
    (transactions(spark, pages, **columns).select(F.explode("records").alias("value"))
     .write.option("lineSep", _CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", max(3, int(file_bytes / per_record))).text(path))


RECORDS = ("type string, record_id string, concurrent_to string, refers_to string, target string, payload_digest string, "
           "content_type string, http string, body binary")
_FIELDS = ("WARC-Type", "WARC-Record-ID", "WARC-Concurrent-To", "WARC-Refers-To", "WARC-Target-URI", "WARC-Payload-Digest", "Content-Type")
_EMIT_BYTES = 8 << 20


def _inflated(content: bytes, step: int = 1 << 20):
    """The bytes of a gzip file (one member or many), piece by piece; other files as they are."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    while content:
        d = zlib.decompressobj(31)
        while not d.eof and content:
            out = d.decompress(content, step)
            content = d.unconsumed_tail
            if out:
                yield out
            elif not content:
                break
        content = d.unused_data


def records_of(content: bytes):
    """(header fields, body) of each record of an archive, by Content-Length."""
    source = _inflated(content)
    held = bytearray()

    def need(n: int) -> bool:
        while len(held) < n:
            piece = next(source, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while need(1):
        need(2)                            # a piece may end between CR and LF
        if held[:2] == b"\r\n":
            del held[:2]
            continue
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not need(len(held) + 1):
                return
        head = bytes(held[:end]).decode("utf-8", "replace")
        if not re.match(r"WARC/\d", head):
            raise ValueError(f"not a WARC record: {head[:80]!r}")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.split("\r\n")[1:])
        size = int(fields["Content-Length"])
        if not need(end + 4 + size):
            raise ValueError("the archive ends within a record")
        yield fields, bytes(held[end + 4:end + 4 + size])
        del held[:end + 4 + size]


def _read(batches):
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.binary() if i == len(names) - 1 else pa.string()) for i in range(len(names))], names=names)

    rows, held = [], 0
    for batch in batches:
        for content in batch.column(0):
            for fields, body in records_of(content.as_py()):
                http = None
                if fields.get("Content-Type", "").startswith("application/http"):
                    head, _, body = body.partition(b"\r\n\r\n")
                    http = head.decode("utf-8", "replace")
                rows.append([*(fields.get(f) for f in _FIELDS), http, body])
                held += len(body) + 600
                if held >= _EMIT_BYTES:
                    yield table(rows)
                    rows, held = [], 0
    yield table(rows)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under ``path``; one file at a time is held."""
    on_workers(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(_read, RECORDS)


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """One nested row per capture: capture_id, target, response (type, ids,
    digest, http head, payload), n_responses (records of one id are equal
    copies), requests and metadata (arrays of structs)."""
    r = read_records(spark, path).withColumn("capture_id", F.coalesce("concurrent_to", "record_id"))
    whole = F.when(F.col("type").isin("response", "revisit"), F.struct("type", "record_id", "payload_digest", "refers_to", "http", F.col("body").alias("payload")))
    part = F.struct("record_id", "content_type", "http", F.col("body").cast("string").alias("body"))
    return r.groupBy("capture_id").agg(F.first(whole, True).alias("response"), F.count(whole).alias("n_responses"), F.first("target", True).alias("target"),
                                       F.collect_set(F.when(F.col("type") == "request", part)).alias("requests"),
                                       F.collect_set(F.when(F.col("type") == "metadata", part)).alias("metadata"))
