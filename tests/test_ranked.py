"""Rows stored in order: places and pages without a sort, and how much a page reads."""

import pytest
from pyspark.sql import functions as F

from ddlscope.operators import paging, ranked
from ddlscope.operators.positions import with_position

ORDER = ["schema_name", "object_name"]


def listing(spark, rows=600):
    group = F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "small")  # the rest has no catalog
    return spark.range(rows).select(group.alias("catalog_name"), F.concat(F.lit("s"), F.col("id") % 3).alias("schema_name"),
                                    F.concat(F.lit("o"), F.xxhash64("id")).alias("object_name"), F.col("id").alias("n"))


def stored(spark, folder, rows=600, partitions=9):
    order = [F.col(c) for c in ORDER]
    return ranked.store(listing(spark, rows), folder, order, ["catalog_name"], ["object_name"], partitions)


def same(found, wanted):
    wanted = wanted.select(*found.columns)
    return found.exceptAll(wanted).count() == 0 and wanted.exceptAll(found).count() == 0


def scanned(frame):
    """Rows that the scans of the frame's plan gave when it ran."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return [leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()) if "Scan" in leaves.apply(i).nodeName()]


def test_positions_and_totals(spark, folder):
    wanted = with_position(listing(spark), [F.col(c) for c in ORDER], ["catalog_name"], total="size")
    assert same(stored(spark, folder).positions(total="size"), wanted)


@pytest.mark.parametrize("index", [-1, 0, 1, 3, 10**12])
@pytest.mark.parametrize("size", [7, 50, 1000])
def test_pages_of_all_groups_and_of_one(spark, folder, index, size):
    kept = stored(spark, folder)
    paged = paging.paginate(listing(spark), size)
    wanted = paged.where(paging.on_page(index)).select(*listing(spark).columns, "position", "page")
    assert same(kept.page(index, size), wanted)
    for name in ("big", "small", None):
        assert same(kept.page_of([name], index, size), wanted.where(F.col("catalog_name").eqNullSafe(F.lit(name))))
    assert kept.page_of(["unknown"], index, size).count() == 0


def test_directory(spark, folder):
    found = stored(spark, folder).directory().orderBy("catalog_name", "_part").collect()
    assert len(found) <= 9 + 3
    for name in ("big", "small", None):
        parts = [r for r in found if r["catalog_name"] == name]
        assert [r["before"] for r in parts] == [sum(p["rows"] for p in parts[:k]) for k in range(len(parts))]
        assert {r["total"] for r in parts} == {sum(r["rows"] for r in parts)}
    first = listing(spark).where("catalog_name = 'big'").orderBy(*ORDER).first()
    assert next(r for r in found if r["catalog_name"] == "big")["first_keys"]["object_name"] == first["object_name"]


def test_a_late_page_reads_no_more_than_an_early_one(spark, folder):
    kept = stored(spark, folder, rows=60000, partitions=40)
    read = [sum(scanned(kept.page_of(["big"], index, 100))) for index in (0, 7, 200, 10**6)]
    assert max(read) <= 2 * 2100 and max(read[1:]) <= 2 * read[0]


def test_without_groups_and_without_rows(spark, folder):
    rows = listing(spark).drop("catalog_name")
    kept = ranked.store(rows, f"{folder}/a", [F.col("object_name"), F.col("n")], partitions=4)
    wanted = rows.orderBy("object_name", "n").offset(20).limit(10)
    assert same(kept.page_of([], 2, 10).drop("position", "page"), wanted) and same(kept.page(2, 10).drop("position", "page"), wanted)
    none = ranked.store(listing(spark).where("false"), f"{folder}/b", [F.col("n")], ["catalog_name"])
    assert none.page_of(["big"], 0, 10).count() == 0 and none.page(0, 10).count() == 0 and none.positions().count() == 0
