"""What gzip files say about themselves at their end: the size and checksum of the text in them.

A file's last eight bytes are read and nothing else, so the bytes of an export can be checked without unpacking it. Each file is
one gzip member, as Spark's writers make them; of several members the last one's numbers would come. The size is stored
modulo 2**32."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FILES_PER_TASK = 500
_SCHEMA = pa.schema([("path", pa.string()), ("file_bytes", pa.int64()), ("text_bytes", pa.int64()), ("crc32", pa.int64())])


class Files(InputPartition):
    def __init__(self, files: Sequence[tuple[str, int]]):
        self.files = list(files)


class _Reader(DataSourceReader):
    def __init__(self, root: str):
        self.root = root if "://" in root or root.startswith("file:") else f"file://{root}"

    def partitions(self) -> list[Files]:
        files, top = fs.FileSystem.from_uri(self.root)
        found = files.get_file_info(fs.FileSelector(top, recursive=True))
        named = sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(".gz"))
        return [Files(named[k:k + FILES_PER_TASK]) for k in range(0, len(named), FILES_PER_TASK)] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        files, _ = fs.FileSystem.from_uri(self.root)
        rows = []
        for path, size in partition.files:
            with files.open_input_file(path) as file:
                crc, text = struct.unpack("<II", file.read_at(8, size - 8))
            rows.append({"path": path, "file_bytes": size, "text_bytes": text, "crc32": crc})
        yield pa.RecordBatch.from_pylist(rows, _SCHEMA)


class GzipTrailers(DataSource):
    """`format("gzip_trailers")`: one row for each `.gz` file below the path."""

    @classmethod
    def name(cls) -> str:
        return "gzip_trailers"

    def schema(self) -> str:
        return "path string, file_bytes bigint, text_bytes bigint, crc32 bigint"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


def trailers(spark: SparkSession, path: str) -> DataFrame:
    """Path, bytes, and bytes and checksum of the text of each gzip file below the path, a folder of a file system pyarrow opens."""
    spark.dataSource.register(GzipTrailers)
    return spark.read.format("gzip_trailers").load(path)
