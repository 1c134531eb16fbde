import base64
import hashlib

from pyspark.sql import functions as F

from stratlab.llm import warc
from stratlab.llm.common import Scratch

PAGES = "page_id long, url string, html string, digest string, key string"


def read_back(spark, pages, **options):
    scratch = Scratch(spark, "warc-test")
    path = scratch.path("archives")
    warc.write_archives(pages, path, **options)
    return scratch.write(warc.read_records(spark, path), "records")


def test_round_trip_and_revisits(spark):
    tricky = "x WARC/1.1\r\nWARC-Type: response\r\n\r\nContent-Length: 3\r\n\r\n\r\n\r\nWARC/1.1\r\n é日"
    rows = [(5, "http://a.b/c?d", "same", "x", "y"), (3, "http://a.b/", "same", None, None), (3, "http://a.b/", "same", None, None),
            (9, None, tricky, "x", "y"), (8, "http://z y/\r\n", None, "x", "y"), (2, "u", "", "x", "y"), (None, "n", "same", "x", "y"),
            (1, "long", "<p>" * 100_000, "x", "y")]
    records = read_back(spark, spark.createDataFrame(rows, PAGES), records_per_file=5)
    captures = warc.assemble(records).select(
        F.col("metadata")[0]["fields"]["page-id"].alias("page"), "response.*", F.size("requests").alias("n"), F.size("metadata").alias("m")).collect()
    assert len(captures) == len(rows) and all(c.n == 1 and c.m == 1 for c in captures)
    payloads = {c.page: bytes(c.payload) for c in captures if c.type == "response"}
    assert payloads == {"3": b"same", "9": tricky.encode(), "2": b"", "1": b"<p>" * 100_000}
    for c in captures:
        if c.type == "response":
            digest = base64.b32encode(hashlib.sha1(payloads[c.page]).digest()).decode()
            assert c.payload_digest == c.declared_digest == digest and c.payload_bytes == len(payloads[c.page])
    first = {c.page: c.record_id for c in captures if c.type == "response"}
    assert sorted((c.page, c.refers_to) for c in captures if c.type == "revisit") == sorted(
        [("5", first["3"]), ("3", first["3"]), ("", first["3"]), ("8", first["2"])])


def test_small_payloads_are_not_revisited(spark):
    pages = spark.createDataFrame([(1, "u", "ab", None, None), (2, "u", "ab", None, None), (3, "u", "abc", None, None), (4, "u", "abc", None, None)], PAGES)
    got = read_back(spark, pages, min_revisit_bytes=3).where("type in ('response', 'revisit')").groupBy("type").count().collect()
    assert {r["type"]: r["count"] for r in got} == {"response": 3, "revisit": 1}


def test_partners_in_either_direction_and_none(spark):
    rows = [("r1", "response", ["q1"], None), ("q1", "request", [], None), ("m1", "metadata", ["r1"], None),
            ("q2", "request", ["gone"], None), ("m2", "metadata", [], None)]
    df = spark.createDataFrame(rows, "record_id string, type string, concurrent_to array<string>, refers_to string")
    for name, kind in (("target_uri", "string"), ("date", "string"), ("declared_digest", "string"), ("payload_bytes", "bigint"),
                       ("payload_digest", "string"), ("fields", "map<string,string>"), ("payload", "binary")):
        df = df.withColumn(name, F.lit(None).cast(kind))
    got = {r.capture_id: r for r in warc.assemble(df).collect()}
    assert set(got) == {"r1", "gone", "m2"}
    assert [q.record_id for q in got["r1"].requests] == ["q1"] and [m.record_id for m in got["r1"].metadata] == ["m1"]
    assert got["gone"].response is None and got["m2"].response is None


def test_no_pages(spark):
    assert read_back(spark, spark.createDataFrame([], PAGES)).count() == 0


def test_registered_query_against_brute_force(spark, tmp_path):
    """All columns of the query, with a null page_id, null and repeated html."""
    import base64
    import hashlib

    from stratlab.llm.queries import op8_warc

    rows = [(5, "http://a/x", "<p>one</p>"), (2, "http://a/y", "<p>one</p>"), (9, None, None), (3, "u", ""), (7, "http://b", "é WARC/1.1\r\n x"),
            (None, "http://c", "<p>null id</p>"), (11, "http://d", "<p>null id</p>")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        is_first = first[h or ""] == i
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if is_first else "revisit",
                     None if is_first else first[h or ""]))
    assert sorted(map(tuple, op8_warc(spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str)
