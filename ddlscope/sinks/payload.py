"""The payload as ordered, compressed text files."""

from __future__ import annotations

import bz2
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ddlscope.functions.ddl import export_chunk
from ddlscope.fixed import RAW_LIMIT_BYTES, WIRE_LIMIT_BYTES
from ddlscope.functions.sizes import json_bytes, size_verdict
from ddlscope.functions.text import listing_order
from ddlscope.operators.packing import packed
from ddlscope.operators.sizing import with_chunk
from ddlscope.schemas import KEYS
from ddlscope.sources.gzipped import trailers

# How a writer of partitioned files names a folder for a value that is null or empty.
_NO_NAME = "__HIVE_DEFAULT_PARTITION__"


def write_payload(objects: DataFrame, path: str, keep_catalog: bool = False, compression: str = "gzip",
                  lead: Sequence[str] = (), partitions: int | None = None) -> None:
    """Write the exported texts of objects that have DDL, one folder per catalog, within folders for the `lead` columns. Its part files, concatenated in name
    order, are the payload and one line feed.

    Range partitioning on the full listing order spreads a large schema over many files, and no text passes through
    one task; `partitions` says how many parts there are, else the session's setting. The texts are rewritten after the sort: the pass that samples the split points does not rewrite them, and
    rows of one catalog follow each other, so its pattern is compiled once. The writer ends each row with the line feed
    that joins the texts."""
    # A catalog that cannot be null needs no conversion by the writer, which would make it sort again.
    folders = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in (*lead, "catalog_name")]
    named = objects.select(*folders, "schema_name", "object_name", "ddl")
    order = [*(F.col(c) for c in lead), *listing_order()]
    spread = named.repartitionByRange(partitions, *order) if partitions else named.repartitionByRange(*order)
    (spread.sortWithinPartitions(*order).select(*lead, "catalog_name", export_chunk(keep_catalog).alias("chunk"))
     .write.partitionBy(*lead, "catalog_name").option("compression", compression).text(path))


def read_payload(spark: SparkSession, path: str, lead: Sequence[str] = ()) -> DataFrame:
    """The lines of written payloads. Only a line feed ends one, so that carriage returns within texts stay."""
    schema = ", ".join(["value string", *(f"`{c}` string" for c in (*lead, "catalog_name"))])
    return spark.read.schema(schema).option("lineSep", "\n").text(path)


def text_sizes(spark: SparkSession, path: str, envelope_bytes: int = 0, lead: Sequence[str] = ()) -> DataFrame:
    """Bytes of each catalog's payload as text and within a JSON body, from the files: the same numbers as
    `sizing.payload_sizes`, without joining and rewriting the texts once more. The last line feed is the writer's."""
    return read_payload(spark, path, lead).groupBy(*lead, "catalog_name").agg(
        (F.sum(F.octet_length("value").cast("bigint") + 1) - 1).alias("raw_bytes"),
        (F.sum(json_bytes("value") + 2) - 2 + envelope_bytes).alias("body_bytes"))


def wire_sizes(spark: SparkSession, path: str, lead: Sequence[str] = ()) -> DataFrame:
    """Compressed bytes of each catalog's payload: the sum over its part files, read from the file listing alone.
    One stream over all of it would come out slightly smaller. Names are taken from the last folders of a file's path, so
    those of the folders above do not matter."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    return _by_folder(files, lead, (F.sum("length").alias("wire_bytes"), F.count("*").alias("files")))


def written_sizes(spark: SparkSession, path: str, lead: Sequence[str] = ()) -> DataFrame:
    """Bytes of each catalog's payload as text, and of its part files, as the ends of the gzip files state them: what was written,
    against which `sizing.payload_sizes` can be held. No file is unpacked. The last line feed is the writer's. A part file of 4 GB
    of text and more states its size modulo 2**32."""
    sizes = ((F.sum("text_bytes") - 1).alias("raw_bytes"), F.sum("file_bytes").alias("wire_bytes"), F.count("*").alias("files"))
    return _by_folder(trailers(spark, path), lead, sizes)


def _by_folder(files: DataFrame, lead: Sequence[str], sums: Sequence[Column]) -> DataFrame:
    """Sums over the files of each catalog, named by the last folders of their paths, in which names are escaped."""
    names = [*lead, "catalog_name"]
    folders = "".join(f"/{c}=([^/]*)" for c in names) + "/[^/]*$"
    found = [F.regexp_extract("path", folders, i + 1) for i in range(len(names))]
    decoded = [F.url_decode(F.replace(f, F.lit("+"), F.lit("%2B"))) for f in found]
    return (files.where(F.col("path").rlike(folders))
            .groupBy(*(F.when(d != _NO_NAME, d).alias(c) for c, d in zip(names, decoded))).agg(*sums))


def payload_name(section: str = "section", piece: str = "piece") -> Column:
    """Name of a payload within its catalog; names sort as the payloads do. A text that is a payload of its own ends its section."""
    return F.concat(F.lpad(F.col(section).cast("string"), 8, "0"), F.lit("-"), F.coalesce(F.lpad(F.col(piece).cast("string"), 8, "0"), F.lit("large")))


def places(objects: DataFrame, limit: int = RAW_LIMIT_BYTES, keep_catalog: bool = False) -> DataFrame:
    """For each object with DDL the payload it goes into, its position in the catalog's listing, and its bytes. Only keys and sizes are
    placed."""
    sizes = with_chunk(objects, keep_catalog).select(*KEYS, F.octet_length("chunk").cast("bigint").alias("bytes"))
    return packed(sizes, limit, listing_order()).select(*KEYS, payload_name().alias("payload"), "position", "bytes")


def write_packed(objects: DataFrame, path: str, limit: int = RAW_LIMIT_BYTES, keep_catalog: bool = False, compression: str = "gzip") -> DataFrame:
    """Write the exported texts packed into payloads of at most `limit` bytes, each one file, and a manifest, which is returned: for each
    payload its objects, the first and the last position, the bytes of the text, of the file and a digest of the file, and the two verdicts.

    A payload is written by one task, which its size bounds; so its compressed size is that of one stream, and exact. The manifest
    is written last: without it the export has not ended. Texts are read twice, for their sizes and to be written, and
    shuffled to be joined to their places and once more into order.

    Payloads may be many and small. So the tasks put the files where they belong and open them again by their names: there
    is no commit that moves each, and no listing of them, on the driver. Codecs are none, gzip, bzip2 and deflate; the path is on a
    file system that pyarrow opens from a URI, and must be new."""
    codec = compression.lower()
    if codec not in _CODECS:
        raise ValueError(f"compression {compression} is none of {', '.join(_CODECS)}")
    spark = objects.sparkSession
    root = _new_folder(spark, f"{path}/payloads")
    named = objects.withColumn("catalog_name", F.coalesce("catalog_name", F.lit("")))
    placed = places(named, limit, keep_catalog)
    whole = with_chunk(named, keep_catalog).select(*KEYS, "chunk").join(placed, list(KEYS))
    order = ["catalog_name", "payload", "position"]
    # Stated numbers of partitions are not merged by their bytes: of small payloads, the files are what takes time.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (whole.repartitionByRange(partitions, "catalog_name", "payload").sortWithinPartitions(*order).select("catalog_name", "payload", "chunk")
     .mapInArrow(_writing(root, codec), "payloads bigint").write.format("noop").mode("overwrite").save())
    counted = placed.groupBy("catalog_name", "payload").agg(
        F.count("*").alias("objects"), F.min("position").alias("first_position"), F.max("position").alias("last_position"),
        (F.sum(F.col("bytes") + 1) - 1).alias("raw_bytes"))
    manifest = packed_files(counted.repartition(partitions, "catalog_name", "payload"), root, codec).select(
        F.nullif("catalog_name", F.lit("")).alias("catalog_name"), "payload", "objects", "first_position", "last_position", "raw_bytes",
        "file_bytes", "sha256", size_verdict("raw_bytes", None, limit).alias("raw_verdict"),
        size_verdict("raw_bytes", "file_bytes", limit, WIRE_LIMIT_BYTES).alias("wire_verdict"))
    manifest.write.parquet(f"{path}/manifest")
    return spark.read.schema(manifest.schema).parquet(f"{path}/manifest")


def packed_files(payloads: DataFrame, root: str, codec: str) -> DataFrame:
    """The payloads with the bytes and the digest of their files, null where there is none. A file is no larger than a payload may be, and is
    read by the task that digests it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = fs.FileSystem.from_uri(root)
        for batch in batches:
            sizes, digests = [], []
            for catalog, payload in zip(batch.column("catalog_name").to_pylist(), batch.column("payload").to_pylist()):
                try:
                    with files.open_input_stream(_file(top, catalog, payload, codec), compression=None) as file:
                        content = file.read()
                except FileNotFoundError:
                    content = None
                sizes.append(None if content is None else len(content))
                digests.append(None if content is None else hashlib.sha256(content).hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
                                             names=[*batch.schema.names, "file_bytes", "sha256"])
    made = [T.StructField("file_bytes", T.LongType()), T.StructField("sha256", T.StringType())]
    return payloads.mapInArrow(run, T.StructType([*payloads.schema, *made]))


#: Ending of a file and what compresses its only stream, at the level that Spark's writers have. A gzip header tells no time.
_CODECS: dict[str, tuple[str, Callable | None]] = {
    "none": ("", None), "uncompressed": ("", None), "gzip": (".gz", partial(zlib.compressobj, 6, wbits=31)),
    "bzip2": (".bz2", bz2.BZ2Compressor), "deflate": (".deflate", zlib.compressobj)}
# What a writer of partitioned files escapes in the name of a folder.
_ESCAPED = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")


def _file(top: str, catalog: str, payload: str, codec: str) -> str:
    """The file of a payload, in a folder of its own as a writer of partitioned files makes them."""
    folder = _ESCAPED.sub(lambda found: f"%{ord(found[0]):02X}", catalog) or _NO_NAME
    return f"{top}/catalog_name={folder}/payload={payload}/part-00000.txt{_CODECS[codec][0]}"


def _new_folder(spark: SparkSession, path: str) -> str:
    """Make a folder that must not be there yet; its full URI."""
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = made.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(made):
        raise FileExistsError(f"{path} exists")
    files.mkdirs(made)
    return files.makeQualified(made).toUri().toString()


class _Stream:
    """A file that gets its name when it is whole, so that a task may run twice."""

    def __init__(self, files: fs.FileSystem, path: str, codec: Callable | None):
        self.files, self.path, self.codec = files, path, codec() if codec else None
        folder, _, name = path.rpartition("/")
        files.create_dir(folder)
        self.part = f"{folder}/_{uuid.uuid4().hex}-{name}"
        self.file = files.open_output_stream(self.part, compression=None, buffer_size=1 << 16)

    def write(self, text: bytes) -> None:
        self.file.write(self.codec.compress(text) if self.codec else text)

    def close(self) -> None:
        if self.codec:
            self.file.write(self.codec.flush())
        self.file.close()
        try:
            self.files.move(self.part, self.path)
        except OSError:  # not every file system replaces the file of an earlier attempt
            self.files.delete_file(self.path)
            self.files.move(self.part, self.path)


def _writing(root: str, codec: str):
    """A function for `mapInArrow` that writes the file of each payload from rows (catalog, payload, chunk) in order. The file ends each
    text with the line feed that joins them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = fs.FileSystem.from_uri(root)
        of, out, done = None, None, 0
        for batch in batches:
            chunks = batch.column("chunk").cast(pa.large_binary()).to_pylist()
            for *key, chunk in zip(batch.column("catalog_name").to_pylist(), batch.column("payload").to_pylist(), chunks):
                if key != of:
                    if out:
                        out.close()
                    of, out, done = key, _Stream(files, _file(top, *key, codec), _CODECS[codec][1]), done + 1
                out.write((chunk or b"") + b"\n")
        if out:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["payloads"])
    return run
