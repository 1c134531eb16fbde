"""WARC archives: writing captures, reading records, assembling transactions (operator 8).

A capture is three records: the response (or a revisit of an equal payload), the
request and a metadata record, tied by WARC-Concurrent-To. Archives are written and
read by Spark's text source, whose record separator is chosen freely, so any
file system that Spark knows will do.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2026-01-01T00:00:00Z"
RECORDS_PER_FILE = 20_000
RECORD = ("record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string, "
          "date string, declared_digest string, payload_bytes bigint, payload_digest string, "
          "fields map<string,string>, payload binary")


def base32_sha1(text: Column) -> Column:
    """Upper-case base32 SHA-1 of the UTF-8 bytes: 40 hex digits in four groups of 8 base32 digits."""
    hexed = F.sha1(text.cast("binary"))
    groups = [F.translate(F.lpad(F.conv(F.substring(hexed, k, 10), 16, 32), 8, "0"),
                          "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for k in (1, 11, 21, 31)]
    return F.concat(*groups)


def record_id(key: Column, copy: Column, kind: str) -> Column:
    h = F.md5(F.concat_ws("/", key, copy.cast("string"), F.lit(kind)))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record without the two line ends after it; headers that are null are left out."""
    lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v, F.lit("\r\n"))).otherwise(F.lit("")) for k, v in headers]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(F.lit(VERSION), *lines, length, block)


def plan_captures(pages: DataFrame, min_revisit_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The rows with a content key, and for each key the response that its rows revisit."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
                        F.coalesce("html", F.lit("")).alias("html")) \
        .withColumn("bytes", F.octet_length("html").cast("bigint")).withColumn("digest", base32_sha1(F.col("html"))) \
        .withColumn("key", F.md5(F.concat_ws("\n", F.coalesce(F.col("page_id").cast("string"), F.lit("")), "digest", "url")))
    small = rows.select("key", "page_id", "digest", "bytes")
    first = small.where(F.col("bytes") >= min_revisit_bytes).groupBy("digest").agg(
        F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "key")).alias("first"))
    keys = small.groupBy("key", "digest").agg(F.max("bytes").alias("b")).join(first, "digest", "left") \
        .select("key", F.col("first.key").alias("first_key"))
    return rows, keys


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = 0, compression: str = "gzip",
                   records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write response or revisit, request and metadata records of every page below ``path``.

    Of rows with equal payloads of at least ``min_revisit_bytes`` bytes the one with the
    smallest page_id (null last, then by content key) is the response, the others revisit it. Null html: empty
    payload. Null url: empty. Repeated rows: one capture each, later copies revisit the first. Other columns
    are not read. An empty table gives archives without records. The html is shuffled once, by
    a key that is unique up to repeated rows; what is grouped by digest holds no html and is combined before its shuffle.
    Files hold at most ``records_per_file`` records.
    """
    rows, keys = plan_captures(pages, min_revisit_bytes)
    from pyspark.sql import Window

    copy = F.row_number().over(Window.partitionBy("key").orderBy("page_id"))
    c = rows.join(keys, "key").withColumn("copy", copy)
    revisit = F.col("first_key").isNotNull() & ((F.col("key") != F.col("first_key")) | (F.col("copy") > 1))
    c = c.withColumn("revisit", revisit).withColumn("rid", record_id(F.col("key"), F.col("copy"), "response")) \
        .withColumn("uri", F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    when = F.lit(DATE)
    main = record([
        ("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")), ("WARC-Record-ID", F.col("rid")),
        ("WARC-Date", when), ("WARC-Target-URI", F.col("uri")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Profile", F.when(F.col("revisit"), PROFILE)),
        ("WARC-Refers-To", F.when(F.col("revisit"), record_id(F.col("first_key"), F.lit(1), "response"))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
    ], F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("html"))))
    target = F.regexp_extract("uri", r"^[a-zA-Z]+://[^/]*(/.*)$", 1)
    host = F.regexp_extract("uri", r"^[a-zA-Z]+://([^/]*)", 1)
    request = record([
        ("WARC-Type", F.lit("request")), ("WARC-Record-ID", record_id(F.col("key"), F.col("copy"), "request")),
        ("WARC-Date", when), ("WARC-Target-URI", F.col("uri")), ("WARC-Concurrent-To", F.col("rid")),
        ("Content-Type", F.lit("application/http; msgtype=request")),
    ], F.concat(F.lit("GET "), F.when(target == "", "/").otherwise(target), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit("\r\n\r\n")))
    metadata = record([
        ("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", record_id(F.col("key"), F.col("copy"), "metadata")),
        ("WARC-Date", when), ("WARC-Target-URI", F.col("uri")), ("WARC-Concurrent-To", F.col("rid")),
        ("Content-Type", F.lit("application/warc-fields")),
    ], F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\n")))
    c.select(F.explode(F.array(request, main, metadata)).alias("value")).write \
        .option("lineSep", "\r\n\r\n").option("compression", compression) \
        .option("maxRecordsPerFile", records_per_file).text(path)


def parse_record(raw: bytes, with_payload: bool) -> tuple:
    """The columns of RECORD for one record, without the version line."""
    head, _, block = raw.partition(b"\r\n\r\n")
    headers: dict[str, list[str]] = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        name, _, value = line.partition(":")
        headers.setdefault(name.strip().lower(), []).append(value.strip())
    one = lambda name: headers.get(name, [None])[0]
    block = block[:int(one("content-length") or 0)]
    kind, fields, payload = one("warc-type"), None, None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
    elif kind == "metadata":
        fields = [tuple(x.strip() for x in line.partition(":")[::2])
                  for line in block.decode("utf-8", "replace").split("\r\n") if line]
        fields = list(dict(fields).items())
    declared = one("warc-payload-digest")
    return (one("warc-record-id"), kind, headers.get("warc-concurrent-to", []), one("warc-refers-to"),
            one("warc-target-uri"), one("warc-date"), declared and declared.partition(":")[2],
            None if payload is None else len(payload),
            None if payload is None else base64.b32encode(hashlib.sha1(payload).digest()).decode(),
            fields, payload if with_payload else None)


def whole_records(fragments):
    """Records out of what lies between version lines. A payload may hold a version line
    itself: fragments are joined until the declared length is there."""
    held = b""
    for f in fragments:
        if not held and not f:
            continue  # before the first version line of a file
        held = held + VERSION.encode() + f if held else f
        head, _, block = held.partition(b"\r\n\r\n")
        at = head.lower().find(b"\ncontent-length:")
        if at < 0 and not head.lower().startswith(b"content-length:"):
            raise ValueError("a record without Content-Length")
        length = int(head[at + 1:].split(b"\r\n", 1)[0].split(b":")[1])
        if len(block) >= length:
            yield held
            held = b""
    if held:
        raise ValueError("a record is cut short")


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of compressed archives (which are read file by file, in order), one row each.

    The payload's length and SHA-1 are computed from the payload that was read. ``with_payload``:
    also return its bytes. Memory is bounded by one Arrow batch and the largest record.
    """
    def run(batches):
        names = [c.split()[0] for c in RECORD.replace("map<string,string>", "map").split(", ")]
        kinds = [pa.string(), pa.string(), pa.list_(pa.string())] + [pa.string()] * 4 + [
            pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]
        rows = []
        for raw in whole_records(f for b in batches for f in b.column(0).to_pylist()):
            rows.append(parse_record(raw, with_payload))
            if len(rows) >= 2_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return spark.read.option("lineSep", VERSION).text(path) \
        .select(F.col("value").cast("binary").alias("value")).mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: (capture_id, response, requests, metadata).

    Request and metadata records are joined to the response or revisit that they name in
    WARC-Concurrent-To, or that names them. Records without any such partner make a capture of their
    own with a null response; their capture_id is what they name, or else their own id. ``records``
    should be a written table: it is read several times. Several requests or metadata records of one
    capture are ordered by record id.
    """
    companion = F.col("type").isin("request", "metadata")
    anchors = records.where(~companion).select(F.col("record_id").alias("capture_id"), F.struct(
        "record_id", "type", "target_uri", "date", "refers_to", "declared_digest", "payload_bytes", "payload_digest",
        "payload").alias("response"), F.col("concurrent_to").alias("names"))
    rest = records.where(companion)
    forward = rest.select("record_id", F.explode("concurrent_to").alias("capture_id")) \
        .join(anchors.select("capture_id"), "capture_id", "left_semi")
    backward = anchors.select("capture_id", F.explode("names").alias("record_id"))
    links = forward.select("record_id", "capture_id").union(backward.select("record_id", "capture_id")).distinct()
    tied = rest.join(links, "record_id", "left").select(
        F.coalesce("capture_id", F.try_element_at("concurrent_to", F.lit(1)), "record_id").alias("capture_id"), "type",
        F.struct("record_id", "target_uri", "date", "fields").alias("r"))
    groups = tied.groupBy("capture_id").agg(
        F.collect_list(F.when(F.col("type") == "request", F.struct("r.record_id", "r.target_uri", "r.date"))).alias("requests"),
        F.collect_list(F.when(F.col("type") == "metadata", F.struct("r.record_id", "r.fields"))).alias("metadata"))
    by_id = "transform(array_sort(transform({0}, x -> x.record_id)), i -> filter({0}, x -> x.record_id = i)[0])"
    groups = groups.select("capture_id", F.expr(by_id.format("requests")).alias("requests"),
                           F.expr(by_id.format("metadata")).alias("metadata"))
    return anchors.drop("names").join(groups, "capture_id", "full")
