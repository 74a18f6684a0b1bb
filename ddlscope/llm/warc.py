"""WARC as a Python data source: `spark.read.format("warc")` and `df.write.format("warc")`.

Reading plans partitions of files by size; a large file that was written here is cut at records, whose places the manifest
has. Filters on the header columns are pushed down; each record's headers are parsed
first, and the payload of a record that the filters leave out, or of any if the option `payload` is false, is never decoded:
where the gzip member says how long it is (its extra field `sl`), it is not even read. Without that field a member is
decompressed but not kept.

Writing makes a gzip member for each record, in files of about `file_bytes`. A task writes files of its own, and only those
that the job commits are listed in the folder's manifest, by which it is read; what a lost or repeated task has left is not read. A
folder or file without a manifest, from elsewhere, is read by its names, compressed or not.

Columns: see `SCHEMA`. To write, give record_type ('response' or 'revisit'), record_id, target_uri, payload (binary), payload_digest
(SHA-1 in hex), payload_bytes, refers_to and refers_to_uri; others are ignored.

A digest is read in hex where its label, or without one its form, says how long it is; any other is kept as it is stated.

Defined cases: a null payload is an empty one; a null or empty header is left out and read as null; control characters in a header
become spaces; an empty table writes an empty manifest, which reads as no rows; repeated rows are records of their own."""

from __future__ import annotations

import base64
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition,
                                    IsNotNull, StringStartsWith, WriterCommitMessage)

from ddlscope.llm.texts import bound_batches
from ddlscope.session import scratch_path

SCHEMA = ("record_type string, record_id string, target_uri string, date string, content_type string, content_length long, "
          "payload_digest string, payload_bytes long, refers_to string, payload binary")
# Names and texts of the format.
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
           "content_type": "Content-Type", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_manifest.json"
HEAD_BYTES = 1 << 16
#: Bytes of the digests that are read in hex, by label.
DIGESTS = {"md5": 16, "sha1": 20, "sha-1": 20, "sha256": 32, "sha-256": 32, "sha512": 64, "sha-512": 64}
#: A file is cut for reading at the first record after each so many bytes.
CUT_BYTES = 16 << 20
#: Up to so many bytes of digests and addresses of repeated payloads are sent to every task; beyond that pages are shuffled.
SENT_BYTES = 32 << 20
#: A filter on these columns is decided by the headers.
PUSHED = (EqualTo, In, IsNotNull, StringStartsWith)


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" not in path:
        path = "file://" + re.sub("^file:", "", path)
    return fs.FileSystem.from_uri(path)


def clean(value: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f]+", " ", value).strip()


def http_head(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def member(data: bytes, level: int) -> bytes:
    """A gzip member whose extra field `sl` tells its own length and that of the data."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    total = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + struct.pack("<H2sHII", 12, b"sl", 8, total & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def encode(row: dict, date: str) -> bytes:
    payload, is_revisit = row.get("payload") or b"", row.get("record_type") == "revisit"
    length = row["payload_bytes"] if row.get("payload_bytes") is not None else len(payload)
    block = http_head(length) + (b"" if is_revisit else payload)
    digest = row.get("payload_digest")
    lines = [("WARC-Type", row.get("record_type") or "response"), ("WARC-Record-ID", row.get("record_id")), ("WARC-Date", date),
             ("WARC-Target-URI", row.get("target_uri")),
             ("WARC-Payload-Digest", digest and "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
             ("WARC-Profile", PROFILE if is_revisit else None), ("WARC-Refers-To", row.get("refers_to")),
             ("WARC-Refers-To-Target-URI", row.get("refers_to_uri")), ("Content-Type", "application/http; msgtype=response"),
             ("Content-Length", str(len(block)))]
    head = "".join(f"{name}: {clean(value)}\r\n" for name, value in lines if value and clean(value))
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple]


class Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.file_bytes, self.cut_bytes = int(options.get("file_bytes", 64 << 20)), int(options.get("cut_bytes", CUT_BYTES))
        self.level, self.date = int(options.get("level", 6)), options.get("date", "1970-01-01T00:00:00Z")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        store, folder = open_store(self.path)
        store.create_dir(folder, recursive=True)
        files, out, name, size, cuts = [], None, "", 0, []
        for batch in batches:
            for row in (row for i in range(0, len(batch), 64) for row in batch.slice(i, 64).to_pylist()):
                if out is None:
                    name, size, cuts = f"part-{uuid.uuid4().hex}.warc.gz", 0, []
                    out = store.open_output_stream(f"{folder}/{name}", compression=None)
                data = member(encode(row, self.date), self.level)
                if size - (cuts[-1] if cuts else 0) >= self.cut_bytes:
                    cuts.append(size)
                out.write(data)
                size += len(data)
                if size >= self.file_bytes:
                    out.close()
                    files, out = [*files, (name, size, cuts)], None
        if out is not None:
            out.close()
            files.append((name, size, cuts))
        return Written(files)

    def commit(self, messages: Sequence[Written | None]) -> None:
        store, folder = open_store(self.path)
        store.create_dir(folder, recursive=True)
        files = [] if self.overwrite else manifest(store, folder) or []
        files += [list(f) for m in messages if m for f in m.files]
        with store.open_output_stream(f"{folder}/{MANIFEST}.new", compression=None) as out:
            out.write(json.dumps(files).encode())
        store.move(f"{folder}/{MANIFEST}.new", f"{folder}/{MANIFEST}")

    def abort(self, messages: Sequence[Written | None]) -> None:
        """The files of tasks that ended go; those of tasks that were lost are in no manifest."""
        store, folder = open_store(self.path)
        for name in (f[0] for m in messages if m for f in m.files):
            store.delete_file(f"{folder}/{name}")


def manifest(store: fs.FileSystem, folder: str) -> list | None:
    if store.get_file_info(f"{folder}/{MANIFEST}").type == fs.FileType.NotFound:
        return None
    with store.open_input_stream(f"{folder}/{MANIFEST}") as data:
        return json.loads(data.read())


@dataclass
class Files(InputPartition):
    """Pieces of files: path, first byte and end, each at a record."""

    pieces: list[tuple[str, int, int]] = field(default_factory=list)


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.filters = options["path"], []
        self.partition_bytes = int(options.get("partition_bytes", CUT_BYTES))
        self.payload = options.get("payload", "true").lower() == "true"

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, PUSHED) and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> Sequence[Files]:
        """Pieces of files packed up to the size of a partition. A file from elsewhere is one piece, however large."""
        store, path = open_store(self.path)
        info = store.get_file_info(path)
        if info.type == fs.FileType.File:
            found = [(path, info.size, [])]
        else:
            listed = manifest(store, path)
            found = ([(f"{path}/{n}", s, *(cuts or [[]])) for n, s, *cuts in listed] if listed is not None else
                     [(f.path, f.size, []) for f in store.get_file_info(fs.FileSelector(path, recursive=True))
                      if f.type == fs.FileType.File and re.search(r"\.warc(\.gz)?$", f.path)])
        parts, held = [], self.partition_bytes
        for name, size, cuts in sorted(found):
            for start, end in zip([0, *cuts], [*cuts, size]):
                if held + end - start > self.partition_bytes:
                    parts.append(Files())
                    held = 0
                parts[-1].pieces.append((name, start, end))
                held += end - start
        return parts or [Files()]

    def wanted(self, head: dict[str, str | None]) -> bool:
        for f in self.filters:
            value = head.get(f.attribute[0])
            if value is None or (isinstance(f, EqualTo) and value != f.value) or (isinstance(f, In) and value not in f.value) or (
                    isinstance(f, StringStartsWith) and not value.startswith(f.value)):
                return False
        return True

    def read(self, partition: Files) -> Iterator[tuple]:
        store, _ = open_store(self.path)
        for name, start, end in partition.pieces:
            with store.open_input_file(name) as data:
                yield from records(data, self.wanted, self.payload, start, end)


class Warc(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(dict(self.options), overwrite)


def fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs if value}


def hex_digest(value: str | None) -> str | None:
    """The digest in hex without its label, from hex or base 32. One of an unknown label or of another length, and one that is
    neither, is returned as it is stated."""
    if not value:
        return None
    label, _, digest = value.rpartition(":")
    sizes = [DIGESTS.get(label.strip().lower())] if label else sorted(set(DIGESTS.values()))
    digest = digest.strip()
    for size in sizes:
        if size and len(digest) == 2 * size and re.fullmatch("[0-9A-Fa-f]+", digest):
            return digest.lower()
    letters = digest.rstrip("=").upper()
    for size in sizes:
        if size and len(letters) == -(-size * 8 // 5) and re.fullmatch("[A-Z2-7]+", letters):
            return base64.b32decode(letters + "=" * (-len(letters) % 8)).hex()
    return value


class Source:
    """Bytes of one record at a time: a gzip member that is decompressed as far as asked for, or plain text."""

    def __init__(self, data: pa.NativeFile):
        self.data, self.size, self.at = data, data.size(), 0

    def peek(self, count: int) -> bytes:
        return self.data.read_at(min(count, self.size - self.at), self.at) if self.at < self.size else b""


class Member:
    """A gzip member from its first byte on."""

    def __init__(self, source: Source, first: bytes):
        self.source, self.start = source, source.at
        extra = first[12:12 + struct.unpack("<H", first[10:12])[0]] if first[3] & 4 else b""
        self.length = struct.unpack("<I", extra[4:8])[0] if extra[:2] == b"sl" else 0
        self.unpack, self.used, self.out = zlib.decompressobj(31), 0, bytearray()

    def more(self) -> bool:
        if self.unpack.eof:
            return False
        got = self.unpack.unconsumed_tail
        if not got:
            got = self.source.data.read_at(min(HEAD_BYTES, self.source.size - self.start - self.used), self.start + self.used)
            self.used += len(got)
            if not got:
                return False
        self.out += self.unpack.decompress(got, HEAD_BYTES)
        return True

    def until(self, mark: bytes) -> int:
        at = -1
        while (at := self.out.find(mark)) < 0 and self.more():
            pass
        return at

    def upto(self, count: int) -> bytes:
        while len(self.out) < count and self.more():
            pass
        return bytes(self.out[:count])

    def end(self) -> int:
        """Where the next member begins."""
        if self.length:
            return self.start + self.length
        while self.more():
            self.out.clear()  # decompressed only to find the end
        return self.start + self.used - len(self.unpack.unused_data)


class Plain:
    """A record that is not compressed."""

    def __init__(self, source: Source):
        self.source, self.start, self.length = source, source.at, 0

    def until(self, mark: bytes) -> int:
        size = HEAD_BYTES
        while True:
            got = self.source.peek(size)
            if (at := got.find(mark)) >= 0 or len(got) < size:
                return at
            size *= 2

    def upto(self, count: int) -> bytes:
        return self.source.peek(count)

    def end(self) -> int:
        return self.start + self.length


def records(data: pa.NativeFile, wanted, with_payload: bool, start: int = 0, end: int | None = None) -> Iterator[tuple]:
    """The rows of one file, or of those of its records that begin between two places. The payload is decoded after the headers
    have been accepted."""
    source = Source(data)
    source.at, last = start, source.size if end is None else end
    while source.at < last:
        first = source.peek(64)
        if first[:2] != b"\x1f\x8b" and first[:5] != b"WARC/":
            blank = len(first) - len(first.lstrip())
            if not blank:
                raise ValueError(f"no record at byte {source.at}")
            source.at += blank
            continue
        record = Member(source, first) if first[:2] == b"\x1f\x8b" else Plain(source)
        head_end = record.until(b"\r\n\r\n")
        if head_end < 0:
            raise ValueError(f"a record without an end of its headers at byte {record.start}")
        head = fields(record.upto(head_end))
        size = int(head.get("content-length", 0))
        if isinstance(record, Plain):
            record.length = head_end + 4 + size
        row = {column: head.get(name.lower()) or None for column, name in HEADERS.items()}
        row["payload_digest"] = hex_digest(row["payload_digest"])
        if wanted(row):
            payload, stated = None, None
            if (row["content_type"] or "").startswith("application/http"):
                block = record.upto(min(head_end + 4 + size, head_end + 4 + HEAD_BYTES))[head_end + 4:]
                cut = block.find(b"\r\n\r\n")
                cut = cut + 4 if cut >= 0 else 0
                length = fields(block[:cut]).get("content-length")
                stated = int(length) if length and length.isdigit() else size - cut
            else:
                cut, stated = 0, size
            if with_payload and row["record_type"] != "revisit":
                payload = record.upto(head_end + 4 + size)[head_end + 4 + cut:]
            yield (row["record_type"], row["record_id"], row["target_uri"], row["date"], row["content_type"], size,
                   row["payload_digest"], stated, row["refers_to"], payload)
        source.at = record.end()


def archive_rows(pages: DataFrame, least: int = 1000) -> DataFrame:
    """The records of the pages (page_id, url, html). Of pages with equal payloads of at least so many bytes, that with the
    greatest id is the response and the others revisit it. Pages without an id are responses.

    Repeated payloads are found by their digests alone, once and in a table. Where that is measured to be small it goes to every
    task and no payload is shuffled; beyond `SENT_BYTES` pages and digests are shuffled to each other."""
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    first = (rows.filter((F.col("size") >= least) & F.col("page_id").isNotNull()).groupBy("digest")
             .agg(F.max(F.struct("page_id", "url")).alias("kept"), F.count("*").alias("n")).filter("n > 1").select("digest", "kept"))
    spark, path = pages.sparkSession, scratch_path(pages.sparkSession, "repeated")
    first.write.parquet(path)
    first = spark.read.schema(first.schema).parquet(path)
    weight = first.agg(F.sum(F.coalesce(F.octet_length("kept.url"), F.lit(0)) + F.lit(100))).first()[0] or 0
    joined = rows.join(F.broadcast(first) if weight <= SENT_BYTES else first, "digest", "left")
    revisit = F.coalesce((F.col("page_id") != F.col("kept.page_id")) & (F.col("size") >= least), F.lit(False))
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    return joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), urn(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"), F.when(~revisit, F.col("payload")).alias("payload"), F.col("digest").alias("payload_digest"),
        F.col("size").alias("payload_bytes"), F.when(revisit, urn(F.col("kept.page_id"))).alias("refers_to"),
        F.when(revisit, F.col("kept.url")).alias("refers_to_uri"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Warc)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    bound_batches(spark)


def write(rows: DataFrame, path: str, **options) -> None:
    register(rows.sparkSession)
    rows.write.format("warc").options(**options).mode("append").save(path)


def read(spark: SparkSession, path: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(**options).load(path)
