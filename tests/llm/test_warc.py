import gzip

from pyspark.sql import functions as F

from spindle.llm import queries, warc

TRICKY = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nü"


def test_round_trip(spark, tmp):
    rows = [(1, "http://a/1", TRICKY, "x"), (2, "http://a/2", None, "x"), (3, None, "", "x"), (4, "u\r\nv", TRICKY, "x"), (None, "n", "own", "x"), (6, "s", "z" * 70000, "x"),
            (7, "r", "same", "x"), (7, "r", "same", "x"), (8, "q", "same", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, records string").repartition(3)
    for n, broadcast_rows in enumerate((100_000, 0)):
        path = f"{tmp}/{n}"
        warc.write_archives(spark, pages, path, file_bytes=3000, broadcast_rows=broadcast_rows)
        got = {(r.target, r.response.type): r for r in warc.read_captures(spark, path).collect()}
        assert len(got) == 8 and sum(r.n_responses for r in got.values()) == 9
        assert got[("http://a/1", "response")].response.payload.decode() == TRICKY
        assert got[("u v", "revisit")].response.refers_to == got[("http://a/1", "response")].capture_id
        assert got[("s", "response")].response.payload == b"z" * 70000
        assert got[("", "revisit")].response.payload == b"" and got[("http://a/2", "response")].response.payload == b""
        assert got[("r", "response")].n_responses == 2 and got[("q", "revisit")].response.refers_to == got[("r", "response")].capture_id
        assert all(len(r.requests) == 1 == len(r.metadata) and r.requests[0].http.startswith("GET ") for r in got.values())


def test_least_bytes(spark, tmp):
    pages = spark.createDataFrame([(1, "a", "same"), (2, "b", "same"), (3, "c", "longer text"), (4, "d", "longer text")], "page_id long, url string, html string")
    warc.write_archives(spark, pages, f"{tmp}/w", least_bytes=5)
    assert sorted(r.target for r in warc.read_captures(spark, f"{tmp}/w").collect() if r.response.type == "revisit") == ["d"]


def test_empty_table_and_missing_response(spark, tmp):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(spark, pages, f"{tmp}/w")
    assert warc.read_captures(spark, f"{tmp}/w").count() == 0
    record = "WARC/1.1\r\nWARC-Type: request\r\nWARC-Record-ID: <r>\r\nWARC-Concurrent-To: <gone>\r\nContent-Type: application/http;msgtype=request\r\nContent-Length: 4\r\n\r\nGET \r\n\r\n"
    with open(f"{tmp}/one.warc.gz", "wb") as f:
        f.write(gzip.compress(record.encode()) + gzip.compress(record.replace("<r>", "<s>").encode()))
    (row,) = warc.read_captures(spark, f"{tmp}/one.warc.gz").collect()
    assert row.response is None and row.capture_id == "<gone>" and len(row.requests) == 2


def test_records_that_pieces_cut_anywhere():
    def record(size):
        return b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n" % size + b"z" * size + b"\r\n\r\n"

    piece = 1 << 20
    for past in range(-90, 12):                 # the first piece ends within the first record's end or the second record's head
        size = piece - past - len(record(piece)) + piece
        content = gzip.compress(record(size) + record(3) + record(0), 1)
        assert [len(body) for _, body in warc.records_of(content)] == [size, 3, 0]


def test_base32(spark):
    import base64
    import hashlib
    texts = ["", "a", "ü" * 40, "0" * 999]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(warc.base32_sha1(F.col("t"))).collect()
    assert [r[0] for r in got] == [base64.b32encode(hashlib.sha1(t.encode()).digest()).decode() for t in texts]


def test_query_on_odd_pages(spark, tmp):
    spark.createDataFrame([(1, "u", None), (2, None, ""), (3, "v", "p"), (3, "v", "p")], "page_id long, url string, html string").write.parquet(f"{tmp}/pages.parquet")
    got = sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in queries.op6_warc_transactions(spark, tmp).collect())
    assert got == [(1, 0, "response", None), (2, 0, "revisit", 1), (3, 1, "response", None), (3, 1, "response", None)]
