import base64
import gzip
import hashlib
import os

import __spark_entry__ as entry
import pyarrow as pa
from ddlscope.llm import queries, warc
from pyspark.sql import functions as F
from tests.compare import difference
from tests.conftest import SMALL

LONG = "<p>" + "long page " * 200
PAGES = [(1, "http://a/", LONG), (2, "http://b/", LONG), (3, None, LONG), (4, "http://c/\r\nX: y", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""),
         (None, "u", LONG), (8, "u", "é😀" * 50000), (9, "u", "a\r\n\r\nb\r\n\r\nWARC/1.1\r\n"), (10, "u", "x" * 999), (11, "u", "x" * 999), (12, "u", "y" * 1000), (13, "u", "y" * 1000)]


def pages(spark, rows=PAGES):
    made = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return made.withColumns({c: F.lit("clash") for c in ("payload", "digest", "size", "kept", "n")})


def test_round_trip(spark, folder):
    warc.write(warc.archive_rows(pages(spark)), folder + "/w", file_bytes=4000)
    got = {r["record_id"]: r for r in warc.read(spark, folder + "/w").filter("record_id IS NOT NULL").collect()}
    assert len(got) == 13
    for page, url, html in PAGES:
        if page is None:
            continue
        row, data = got[f"<urn:page:{page}>"], (html or "").encode()
        last = {1: 3, 2: 3, 12: 13}.get(page)
        assert row["record_type"] == ("revisit" if last else "response")
        assert row["refers_to"] == (f"<urn:page:{last}>" if last else None)
        assert row["payload"] == (None if last else data)
        assert row["payload_digest"] == hashlib.sha1(data).hexdigest() and row["payload_bytes"] == len(data)
        assert row["target_uri"] == (None if url is None else "http://c/ X: y" if page == 4 else url)
    assert warc.read(spark, folder + "/w").count() == 14


def test_filters_are_pushed_and_payloads_can_be_left(spark, folder):
    warc.write(warc.archive_rows(pages(spark)), folder + "/w")
    some = warc.read(spark, folder + "/w").filter((F.col("record_type") == "revisit") & F.col("record_id").startswith("<urn:page:1"))
    assert sorted(r["record_id"] for r in some.collect()) == ["<urn:page:12>", "<urn:page:1>"]
    reader = warc.Reader({"path": folder + "/w", "payload": "false"})
    left = [warc.EqualTo(("payload_bytes",), 5)]
    assert list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), *left])) == left
    rows = [r for part in reader.partitions() for r in reader.read(part)]
    assert len(rows) == 3 and all(r[0] == "revisit" and r[-1] is None for r in rows)


def test_unwanted_members_are_not_decompressed(folder, monkeypatch):
    path = folder + "/one.warc.gz"
    record = warc.encode({"record_type": "response", "record_id": "<x>", "payload": bytes(range(256)) * 40000, "payload_bytes": 10240000}, "2020-01-01T00:00:00Z")
    with open(path, "wb") as out:
        out.write(warc.member(record, 0) * 3)
    read = []
    monkeypatch.setattr(warc.Member, "more", lambda self, more=warc.Member.more: read.append(1) or more(self))
    store, name = warc.open_store(path)
    with store.open_input_file(name) as data:
        assert list(warc.records(data, lambda head: False, True)) == []
    assert len(read) == 3


def test_archives_from_elsewhere(spark, folder):
    record = warc.encode({"record_type": "response", "record_id": "<x>", "payload": b"abc" * 100000, "payload_bytes": 300000}, "2020-01-01T00:00:00Z")
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: 4\r\n\r\na: b\r\n\r\n"
    with open(folder + "/a.warc", "wb") as out:
        out.write(info + record * 2)
    with gzip.open(folder + "/b.warc.gz", "wb") as out:
        out.write(info)
    with open(folder + "/b.warc.gz", "ab") as out:
        out.write(gzip.compress(record) + gzip.compress(record))
    got = warc.read(spark, folder).groupBy("record_type").agg(F.count("*"), F.sum(F.octet_length("payload"))).collect()
    assert {tuple(r) for r in got} == {("warcinfo", 2, 8), ("response", 4, 1200000)}
    assert warc.read(spark, folder + "/a.warc").count() == 3


def test_no_rows_and_uncommitted_files(spark, folder):
    warc.write(warc.archive_rows(pages(spark, [])), folder + "/none")
    assert warc.read(spark, folder + "/none").count() == 0
    warc.write(warc.archive_rows(pages(spark)), folder + "/w")
    with open(folder + "/w/part-lost.warc.gz", "wb") as out:
        out.write(b"\x1f\x8bhalf")
    assert warc.read(spark, folder + "/w").count() == 14


def test_query_and_its_sql(spark, duck):
    assert difference(queries.QUERIES["op3_warc"](spark, SMALL), duck, entry.oracle_sql()["op3_warc"]) == ""


def test_digests_of_any_label(spark, folder):
    data = b"abc"
    sha1 = hashlib.sha1(data)
    stated = {"md5:" + hashlib.md5(data).hexdigest(): hashlib.md5(data).hexdigest(), "sha256:" + hashlib.sha256(data).hexdigest().upper(): hashlib.sha256(data).hexdigest(),
              "sha256:" + base64.b32encode(hashlib.sha256(data).digest()).decode(): hashlib.sha256(data).hexdigest(),
              "sha1:" + base64.b32encode(sha1.digest()).decode(): sha1.hexdigest(), "sha1:" + base64.b32encode(sha1.digest()).decode().lower(): sha1.hexdigest(),
              "sha1:" + sha1.hexdigest(): sha1.hexdigest(), sha1.hexdigest(): sha1.hexdigest(), hashlib.md5(data).hexdigest(): hashlib.md5(data).hexdigest(),
              base64.b32encode(sha1.digest()).decode(): sha1.hexdigest(), "sha1:": "sha1:", "sha1:8": "sha1:8", "sha1:" + "1" * 32: "sha1:" + "1" * 32,
              "blake3:" + "ab" * 32: "blake3:" + "ab" * 32, "a:b:c": "a:b:c", "md5:" + "é" * 32: "md5:" + "é" * 32, "": None}
    with open(folder + "/a.warc", "wb") as out:
        for k, value in enumerate(stated):
            out.write(f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: {k}\r\nWARC-Payload-Digest: {value}\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n".encode())
        out.write(b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: none\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")
    got = {r["record_id"]: r["payload_digest"] for r in warc.read(spark, folder).collect()}
    assert got == {**{str(k): want for k, want in enumerate(stated.values())}, "none": None}


def test_files_are_cut_at_records(spark, folder):
    warc.write(warc.archive_rows(pages(spark)).coalesce(1), folder + "/w", cut_bytes=300)
    listed = warc.manifest(*warc.open_store(folder + "/w"))
    assert len(listed) == 1 and len(listed[0][2]) >= 4
    whole, cut = warc.Reader({"path": folder + "/w"}), warc.Reader({"path": folder + "/w", "partition_bytes": "1"})
    assert len(whole.partitions()) == 1 and len(cut.partitions()) == len(listed[0][2]) + 1
    rows = lambda reader: sorted((r for part in reader.partitions() for r in reader.read(part)), key=repr)
    assert rows(cut) == rows(whole) and len(rows(cut)) == 14
    assert warc.read(spark, folder + "/w", partition_bytes=1).count() == 14


def test_payloads_are_not_shuffled_where_few_repeat(spark, folder, monkeypatch):
    few = warc.archive_rows(pages(spark))
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(warc, "SENT_BYTES", 0)
    many = warc.archive_rows(pages(spark))
    assert few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()


def test_files_of_a_failed_job_go(folder):
    writer = warc.Writer({"path": folder + "/w"}, False)
    batch = pa.RecordBatch.from_pylist([{"record_type": "response", "record_id": "<x>", "payload": b"abc", "payload_bytes": 3}])
    done = writer.write(iter([batch]))
    assert len(os.listdir(folder + "/w")) == 1
    writer.abort([done, None])
    assert os.listdir(folder + "/w") == []
