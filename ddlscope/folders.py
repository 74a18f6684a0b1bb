"""Numbered folders of written rows, on whatever file system Spark reads. A folder counts once its write has ended."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: What a committed write leaves in its folder.
COMMITTED = "_SUCCESS"


def _open(spark: SparkSession, path: str):
    made = spark._jvm.org.apache.hadoop.fs.Path
    root = made(path)
    return made, root, root.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbered(spark: SparkSession, path: str, name: str):
    made, root, files = _open(spark, path)
    for status in files.listStatus(root) if files.exists(root) else []:
        key, _, number = status.getPath().getName().partition("=")
        if key == name and number.isdigit():
            yield int(number), status.getPath(), files.exists(made(status.getPath(), COMMITTED)), files


def finished(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers N of the committed folders `name=N` below the path, in order."""
    return sorted(number for number, _, committed, _ in _numbered(spark, path, name) if committed)


def remove(spark: SparkSession, path: str, name: str, below: int) -> None:
    """Remove the folders `name=N` with an N below the number, committed or not."""
    for number, folder, _, files in list(_numbered(spark, path, name)):
        if number < below:
            files.delete(folder, True)
