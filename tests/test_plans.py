"""Plans: what reaches the file reader, and what must not occur in any query."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from ddlscope import schemas
from ddlscope.functions.text import like_matches
from ddlscope.operators import failures, selection, sizing
from ddlscope.sources import snapshots
from tests.conftest import SMALL
from workload.registry import QUERIES


def plan(frame):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        frame.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_python_or_unbounded_window(spark, name):
    text = plan(entry.queries()[name](spark, SMALL))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "FlatMapGroups"):
        assert operator not in text
    # A window without partitions may only see what a limit leaves, or one row for each range partition.
    if re.search(r"Exchange SinglePartition", text):
        assert name in {"a14_foreign_summary", "o2_sorted_catalogs", "o3_projects_by_name"}


@pytest.fixture(scope="module")
def snapshot(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("snapshot"))
    objects = [("main", "s", f"t{i}", "TABLE", "CREATE TABLE x") for i in range(100)]
    spark.createDataFrame(objects, schemas.OBJECTS).write.parquet(f"{path}/objects")
    spark.createDataFrame([("main", "s", f"t{i}", False) for i in range(100)], schemas.TABLES).write.partitionBy(
        "catalog_name").parquet(f"{path}/tables")
    spark.createDataFrame([("main", "s", f"t{i}", True) for i in range(100)], schemas.SELECTION).write.parquet(f"{path}/selection")
    spark.createDataFrame([(i, None, 1, 0, "main", "s", f"t{i}", "TABLE", "boom") for i in range(100)], schemas.OUTCOMES).write.parquet(
        f"{path}/outcomes")
    return path


def test_filters_reach_the_reader(spark, snapshot):
    tables = snapshots.read_snapshot(spark, f"{snapshot}/tables", schemas.TABLES)
    text = plan(snapshots.tables(tables, "t*").where("catalog_name = 'main'"))
    assert "Or(IsNull(is_temporary),Not(EqualTo(is_temporary,true)))]" in text
    assert re.search(r"PartitionFilters: \[.*catalog_name#\d+ = main", text)


def test_counts_do_not_read_the_texts(spark, snapshot):
    objects = snapshots.read_snapshot(spark, f"{snapshot}/objects", schemas.OBJECTS)
    chosen = snapshots.read_snapshot(spark, f"{snapshot}/selection", schemas.SELECTION)
    counted = selection.schema_counts(selection.with_selection(objects, chosen))
    assert "ddl" not in plan(counted)
    assert "ddl" not in plan(objects.where(like_matches("object_name", "t*")).groupBy("schema_name").count())


def test_export_filter_reaches_the_reader(spark, snapshot):
    objects = snapshots.read_snapshot(spark, f"{snapshot}/objects", schemas.OBJECTS)
    chosen = snapshots.read_snapshot(spark, f"{snapshot}/selection", schemas.SELECTION)
    text = plan(selection.to_export(selection.with_selection(objects, chosen)))
    assert "IsNotNull(ddl)" in text and "Not(EqualTo(ddl,))" in text


def test_unused_size_is_not_computed(spark, snapshot):
    objects = snapshots.read_snapshot(spark, f"{snapshot}/objects", schemas.OBJECTS)
    sizes = sizing.payload_sizes(sizing.with_chunk(objects))
    assert re.search("to_?json", plan(sizes).lower()) and not re.search("to_?json", plan(sizes.drop("body_bytes")).lower())


def test_tasks_keep_few_rows_of_a_reason_before_the_shuffle(spark, snapshot):
    failed = failures.failures(snapshots.read_snapshot(spark, f"{snapshot}/outcomes", schemas.OUTCOMES))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for within in ([], ["run_id"]):
            text = plan(failures.failure_groups(failed, ["attempt_id"], within))
            assert re.search(r"row_number\(\), 3, Partial", text)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_preview_limits_each_catalog_before_the_shuffle(spark, snapshot):
    objects = snapshots.read_snapshot(spark, f"{snapshot}/objects", schemas.OBJECTS)
    text = plan(sizing.preview(objects, objects, 200))
    assert re.search(r"row_number\(\), 200, Partial", text)
