import base64
import gzip
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from depotlake.llm import queries, warc

PAGES = "page_id long, url string, html string"
LONG = "<p>é ünï</p>" * 200


@pytest.fixture(scope="module")
def page_rows():
    rows = [
        (1, "http://a.example/1", LONG),
        (2, "http://a.example/2", LONG + "x"),
        (3, None, LONG),
        (9, "http://b.example/9", LONG),
        (4, "http://b.example/4\r\nWARC-Type: warcinfo", "short"),
        (5, "http://b.example/5", "short"),
        (6, "u", None),
        (7, None, ""),
        (8, "http://c.example/8", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 100),
        (9, "again", LONG),
        (None, "no id", LONG),
        (None, "none of them", LONG * 2),
        (None, "none of them either", LONG * 2),
        (-3, "below zero", "y" * 2_000_000),
    ]
    return rows


def expected(rows):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        latest = max(same, default=None) if len(data) >= 1000 and sum((h or "").encode() == data for *_, h in rows) > 1 else None
        again = latest is not None and page != latest
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", latest if again else None))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def archive(spark, page_rows, tmp_path_factory):
    folder = f"file://{tmp_path_factory.mktemp('archive')}/pages"
    warc.archive_pages(spark.createDataFrame(page_rows, PAGES).repartition(3), folder)
    return folder


def test_query_reads_back_what_was_written(spark, page_rows, tmp_path):
    spark.createDataFrame(page_rows, PAGES).withColumn("payload", F.lit("clash")).write.parquet(f"{tmp_path}/pages.parquet")
    found = queries.op11_warc_source(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found), key=repr) == expected(page_rows)


def test_payloads_come_back_whole(spark, archive, page_rows):
    rows = warc.read_warc(spark, archive).collect()
    held = {r.record_id: bytes(r.payload).decode() for r in rows if r.record_type == "response" and r.record_id != "urn:page:"}
    assert all(held[f"urn:page:{p}"] == (html or "") for p, _, html in page_rows if p in (2, 4, 5, 6, 7, 8, 9, -3))
    uris = {r.record_id: r.target_uri for r in rows}
    assert uris["urn:page:4"] == "http://b.example/4%0D%0AWARC-Type: warcinfo" and uris["urn:page:3"] is None
    assert {len(r.payload) for r in rows if r.record_type == "revisit"} == {0}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "condition",
    [
        "record_type = 'revisit'",
        "record_type <> 'revisit'",
        "target_uri LIKE 'http://b.%'",
        "target_uri LIKE '%8' AND payload_length > 100",
        "target_uri IS NULL",
        "refers_to IS NOT NULL AND record_id IN ('urn:page:1', 'urn:page:3', 'urn:page:4')",
        "record_id NOT IN ('urn:page:1', 'urn:page:4')",
        "target_uri <=> NULL",
        "content_length BETWEEN 1 AND 300",
        "record_type = 'revisit' OR payload_length = 5",
        "octet_length(payload) = 5",
    ],
)
def test_filters_give_what_they_give_afterwards(spark, archive, condition):
    pushed = warc.read_warc(spark, archive).where(condition)
    every = spark.createDataFrame(warc.read_warc(spark, archive).collect(), warc.READ).where(condition)
    # A map has no order to compare by.
    assert sorted(map(repr, pushed.drop("headers").collect())) == sorted(map(repr, every.drop("headers").collect()))


def test_pushed_filters_leave_the_plan(spark, archive):
    left = lambda condition: " Filter " in plan(warc.read_warc(spark, archive).where(condition))
    assert not left("record_type = 'response' AND payload_length >= 5")
    assert left("octet_length(payload) = 5") and left("record_id = 'a' OR target_uri = 'b'")


def test_unwanted_payloads_are_not_inflated(monkeypatch):
    """A record whose headers fail costs its first block; the next member is found by the length."""
    body = bytes(range(256)) * 40_000
    rows = [
        {"record_id": f"urn:page:{i}", "record_type": kind, "date": None, "target_uri": None, "refers_to": None, "payload_digest": None, "payload": body, "payload_length": None}
        for i, kind in enumerate(["resource", "response", "resource"])
    ]
    data = b"".join(warc.member(warc.record(r)) for r in rows)
    assert gzip.decompress(data) == b"".join(warc.record(r) for r in rows)
    inflated = []
    whole = zlib.decompressobj

    class Counted:
        def __init__(self, bits):
            self.inner = whole(bits)

        def decompress(self, *args):
            out = self.inner.decompress(*args)
            inflated.append(len(out))
            return out

        def __getattr__(self, name):
            return getattr(self.inner, name)

    monkeypatch.setattr(warc.zlib, "decompressobj", Counted)
    source = warc._Gzip(warc.pa.BufferReader(data))
    (found,) = warc.records(source, lambda r: r["record_type"] == "response", True)
    assert found["payload"] == body and sum(inflated) < 1.5 * len(body) + (4 << 20)
    inflated.clear()
    found = list(warc.records(warc._Gzip(warc.pa.BufferReader(data)), lambda r: True, False))
    assert [r["record_type"] for r in found] == ["resource", "response", "resource"]
    assert all(r["payload"] is None and r["payload_length"] == len(body) for r in found) and sum(inflated) <= 3 << 20


def test_archives_of_others(spark, tmp_path):
    """No manifest: a plain file, one member for all records, and a digest that is no SHA-1."""
    http = b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\nbody"
    digest = b"sha1:" + base64.b32encode(hashlib.sha1(b"body").digest())
    raw = (
        b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 4\r\nContent-Type: application/warc-fields\r\n\r\na: b\r\n\r\n"
        b"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <urn:x>\r\nWARC-Payload-Digest: " + digest + b"\r\n"
        b"WARC-Concurrent-To: <1>\r\nWARC-Concurrent-To: <2>\r\n"
        b"Content-Type: application/http;msgtype=response\r\nContent-Length: %d\r\n\r\n" % len(http) + http + b"\r\n\r\n"
        b"WARC/1.0\r\nWARC-Type: metadata\r\nWARC-Payload-Digest: md5:00\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    )
    (tmp_path / "a.warc").write_bytes(raw)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(raw))
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(raw[: raw.index(b"WARC/1.0", 9)]) + gzip.compress(raw[raw.index(b"WARC/1.0", 9) :]))
    (tmp_path / "notes.txt").write_bytes(b"no archive")
    found = warc.read_warc(spark, str(tmp_path)).collect()
    assert len(found) == 9
    by_file = {name: [(r.record_type, bytes(r.payload), r.payload_digest) for r in found if r.file == name] for name in ("a.warc", "b.warc.gz", "c.warc.gz")}
    first = by_file["a.warc"]
    assert first == [("warcinfo", b"a: b", None), ("response", b"body", hashlib.sha1(b"body").hexdigest()), ("metadata", b"", "md5:00")]
    assert by_file["b.warc.gz"] == by_file["c.warc.gz"] == first
    assert {r.headers.get("WARC-Concurrent-To") for r in found if r.record_type == "response"} == {"<1>, <2>"}
    assert warc.read_warc(spark, str(tmp_path), payload=False).where("payload_length = 4").count() == 6
    assert warc.read_warc(spark, f"{tmp_path}/a.warc").count() == 3
    (tmp_path / "d.warc.gz").write_bytes(gzip.compress(raw)[:-30])
    with pytest.raises(Exception, match="ends inside|d.warc.gz"):
        warc.read_warc(spark, str(tmp_path)).collect()


def test_files_are_bounded_and_dealt_by_size(spark, tmp_path):
    rows = [(i, f"u{i}", f"{hashlib.sha512(str(i).encode()).hexdigest()}" * 20) for i in range(200)]
    pages = spark.createDataFrame(rows, PAGES).coalesce(1)
    warc.write_warc(warc.page_records(pages), f"{tmp_path}/w", file_bytes=10_000)
    files = warc.archive_files(f"{tmp_path}/w")
    assert len(files) > 4 and all(size < 14_000 for _, size in files)
    parts = spark.read.format("warc").option("splitBytes", 30_000).load(f"{tmp_path}/w")
    assert 1 < parts.rdd.getNumPartitions() < len(files) and parts.count() == 200
    # A file that no manifest names, as a lost task leaves it, is not read; a second write adds to the folder.
    (tmp_path / "w" / "left.warc.gz").write_bytes(warc.member(b"WARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n"))
    warc.write_warc(warc.page_records(pages.limit(3)), f"{tmp_path}/w")
    assert warc.read_warc(spark, f"{tmp_path}/w").count() == 203
    with pytest.raises(Exception, match="records have the columns"):
        warc.write_warc(pages, f"{tmp_path}/bad")


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], PAGES)
    assert warc.archive_pages(none, f"{tmp_path}/none").count() == 0
    assert warc.read_warc(spark, f"{tmp_path}/not-there").count() == 0
