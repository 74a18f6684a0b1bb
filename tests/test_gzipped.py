"""What the ends of gzip files say, and how far part files are from one stream."""

import gzip
import zlib
from pathlib import Path

import pytest

from ddlscope.sinks import payload
from ddlscope.sources.gzipped import trailers
from tests.conftest import SMALL
from workload.registry import Tables


def test_sizes_and_checksums_are_those_of_the_texts(spark, folder):
    texts = {"a b": b"", "c=d": b"one\n", "é": bytes(range(256)) * 5000}
    for name, text in texts.items():
        Path(folder, name).mkdir()
        Path(folder, name, "part.txt.gz").write_bytes(gzip.compress(text))
    Path(folder, "other.txt").write_bytes(b"no gzip")
    found = {Path(r["path"]).parent.name: r for r in trailers(spark, folder).collect()}
    assert set(found) == set(texts)
    for name, text in texts.items():
        row = found[name]
        assert (row["text_bytes"], row["crc32"]) == (len(text), zlib.crc32(text))
        assert row["file_bytes"] == Path(folder, name, "part.txt.gz").stat().st_size


def test_no_files(spark, folder):
    assert trailers(spark, folder).count() == 0


@pytest.mark.parametrize("partitions", [1, 8])
def test_the_estimate_of_the_wire_size_is_near_that_of_one_stream(spark, folder, partitions):
    """The sum over part files is at least one stream's size, less a few bytes, and at most two in a hundred more for parts of
    some hundred kilobytes, as a part begins without what the one before it had seen."""
    payload.write_payload(Tables(spark, SMALL)("fx_bulk"), f"{folder}/out", partitions=partitions)
    row = payload.written_sizes(spark, f"{folder}/out").first()
    parts = [gzip.decompress(f.read_bytes()) for f in sorted(Path(folder).rglob("*.gz"))]
    whole = b"".join(parts)
    assert row["raw_bytes"] == len(whole) - 1 and row["files"] == len(parts) == partitions
    stream = len(gzip.compress(whole, 6))
    assert stream - 64 <= row["wire_bytes"] <= 1.02 * stream + 40 * partitions
    assert payload.wire_sizes(spark, f"{folder}/out").first()["wire_bytes"] == row["wire_bytes"]


def test_odd_catalog_names(spark, folder):
    rows = [(c, "s", "o", "CREATE TABLE x") for c in ("a/b c=%é+", None, "plain")]
    payload.write_payload(spark.createDataFrame(rows, "catalog_name string, schema_name string, object_name string, ddl string"), f"{folder}/out")
    found = {r["catalog_name"]: r for r in payload.written_sizes(spark, f"{folder}/out").collect()}
    sizes = {r["catalog_name"]: r for r in payload.text_sizes(spark, f"{folder}/out").collect()}
    wire = {r["catalog_name"]: r for r in payload.wire_sizes(spark, f"{folder}/out").collect()}
    assert set(found) == set(wire) and {k: v["raw_bytes"] for k, v in found.items()} == {k: v["raw_bytes"] for k, v in sizes.items()}
