"""Packing of ordered texts into payloads, against one text after the other."""

import gzip
import hashlib
import random
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ddlscope.operators.packing import packed
from ddlscope.sinks import payload
from tests.conftest import SMALL
from workload.queries.export import exported
from workload.registry import Tables


def brute(sizes, limit):
    """(section, piece) of each text in order."""
    half, section, start, out = limit // 2, 0, 0, []
    for size in sizes:
        if size > half:
            out.append((section, None))
            section, start = section + 1, 0
        else:
            out.append((section, start // half))
            start += size + 1
    return out


def tables(seed):
    rng = random.Random(seed)
    small = [rng.randrange(0, 40) for _ in range(400)]
    return {"big": [s if rng.random() < 0.97 else rng.randrange(50, 300) for s in small], "small": [rng.randrange(0, 30) for _ in range(30)],
            "large": [200] * 5, "one": [0], None: [rng.randrange(0, 120) for _ in range(60)]}


@pytest.mark.parametrize("limit", [2, 100, 10**9])
def test_equals_one_after_the_other(spark, limit):
    given = tables(limit)
    rows = [(g, k, n) for g, sizes in given.items() for k, n in enumerate(sizes)]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "catalog_name string, at int, bytes long").repartition(3)
    found = {(r["catalog_name"], r["at"]): r for r in packed(frame, limit, [F.col("at")]).collect()}
    assert len(found) == len(rows)
    for g, sizes in given.items():
        wanted = brute(sizes, limit)
        assert [(found[g, k]["section"], found[g, k]["piece"], found[g, k]["position"]) for k in range(len(sizes))] == [
            (*w, k + 1) for k, w in enumerate(wanted)]
        payloads = {}
        for w, n in zip(wanted, sizes):
            payloads.setdefault(w, []).append(n)
        assert all(len(p) == 1 or sum(p) + len(p) - 1 <= limit for p in payloads.values())
        # No two payloads that follow each other without a large text between them would fit into half a limit.
        assert len(payloads) <= 2 * (sum(sizes) + len(sizes)) // max(limit // 2, 1) + 2 * sum(n > limit // 2 for n in sizes) + 1


def test_no_rows(spark):
    assert packed(spark.createDataFrame([], "catalog_name string, at int, bytes long"), 100, [F.col("at")]).count() == 0


def test_payloads_in_name_order_are_the_unpacked_payload(spark, folder):
    objects = exported(Tables(spark, SMALL))
    manifest = payload.write_packed(objects, f"{folder}/packed", 2000).orderBy("catalog_name", "payload").collect()
    payload.write_payload(objects, f"{folder}/whole", compression="none")
    for catalog in {r["catalog_name"] for r in manifest}:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/packed/payloads/catalog_name={catalog}")
        of = sorted((r["path"], bytes(r["content"])) for r in files.collect())
        rows = [r for r in manifest if r["catalog_name"] == catalog]
        assert len(of) == len(rows) > 3 and [p.split("payload=")[1].split("/")[0] for p, _ in of] == [r["payload"] for r in rows]
        for (_, content), row in zip(of, rows):
            text = gzip.decompress(content)
            assert row["raw_bytes"] == len(text) - 1 <= 2000 and row["file_bytes"] == len(content)
            assert row["sha256"] == hashlib.sha256(content).hexdigest() and row["raw_verdict"] == row["wire_verdict"] == "ok"
        whole = spark.read.format("binaryFile").load(f"{folder}/whole/catalog_name={catalog}").orderBy("path").collect()
        assert b"".join(gzip.decompress(c) for _, c in of) == b"".join(bytes(r["content"]) for r in whole)
        assert [r["first_position"] for r in rows] == [1 + sum(p["objects"] for p in rows[:k]) for k in range(len(rows))]


def test_a_single_text_beyond_the_limit_is_named(spark, folder):
    objects = spark.createDataFrame([(None, "s", n, d) for n, d in (("a", "x" * 500), ("b", "y"), ("c", None))],
                                    "catalog_name string, schema_name string, object_name string, ddl string").where("ddl IS NOT NULL")
    found = payload.write_packed(objects, folder, 100, keep_catalog=True).orderBy("payload").collect()
    assert [(r["catalog_name"], r["objects"], r["raw_verdict"], r["wire_verdict"]) for r in found] == [
        (None, 1, "uncompressed", "uncompressed"), (None, 1, "ok", "ok")]


@pytest.mark.parametrize("compression", ["none", "gzip", "bzip2", "deflate"])
def test_tasks_place_a_file_by_name_for_each_payload(spark, folder, compression):
    catalogs = ["main", "a/b c%=[x]^é'", None]
    rows = [(c, "s", f"t{n:03}", f"CREATE TABLE t{n}" + " é" * (n % 7)) for c in catalogs for n in range(60)]
    objects = spark.createDataFrame(rows, "catalog_name string, schema_name string, object_name string, ddl string").repartition(5)
    path = f"{folder}/with a %20"
    manifest = payload.write_packed(objects, path, 120, keep_catalog=True, compression=compression).collect()
    top = Path(path) / "payloads"
    files = [f for f in top.rglob("*") if f.is_file()]
    # Nothing but the payloads: no checksum files, no marks of a commit, no names that a second attempt would not replace.
    assert len(files) == len(manifest) > 100 and {f.name.split(".")[0] for f in files} == {"part-00000"} and not list(top.rglob("*.crc"))
    digests = Counter((f.parent.name.split("=")[1], hashlib.sha256(f.read_bytes()).hexdigest(), f.stat().st_size) for f in files)
    assert digests == Counter((r["payload"], r["sha256"], r["file_bytes"]) for r in manifest)
    back = spark.read.schema("value string, catalog_name string, payload string").option("lineSep", "\n").text(str(top))
    lines = Counter((r["catalog_name"], r["value"]) for r in back.collect() if r["value"].startswith("CREATE"))
    assert lines == Counter((c, f"{d};") for c, _, _, d in rows)
    with pytest.raises(FileExistsError):
        payload.write_packed(objects, path, 120)


def test_a_task_that_runs_twice_leaves_the_same_files(folder):
    batch = pa.RecordBatch.from_pydict({"catalog_name": ["c", "c", "d"], "payload": ["0", "0", "1"], "chunk": ["x", None, "y"]})
    write = payload._writing(f"file:{folder}", "none")
    for _ in range(2):
        assert sum(b.column(0)[0].as_py() for b in write(iter([batch.slice(0, 1), batch.slice(1)]))) == 2
    files = {str(f.relative_to(folder)): f.read_bytes() for f in Path(folder).rglob("*") if f.is_file()}
    assert files == {"catalog_name=c/payload=0/part-00000.txt": b"x\n\n", "catalog_name=d/payload=1/part-00000.txt": b"y\n"}


def test_a_file_that_is_missing_has_no_digest(spark, folder):
    payloads = spark.createDataFrame([("c", "0")], "catalog_name string, payload string")
    assert [tuple(r) for r in payload.packed_files(payloads, f"file:{folder}", "gzip").collect()] == [("c", "0", None, None)]
    assert payload.packed_files(payloads.limit(0), f"file:{folder}", "gzip").isEmpty()
