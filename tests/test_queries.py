"""Every registered query against its checking SQL, over the whole small tables."""

import pytest

import __spark_entry__ as entry
from workload.registry import QUERIES
from tests.compare import difference
from tests.conftest import SMALL

SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    assert difference(entry.queries()[name](spark, SMALL), duck, SQL[name]) == ""


def test_queries_without_sql_are_the_known_ones():
    assert set(QUERIES) - set(SQL) == {"a11_wire_bytes"}


def test_entry_returns_the_listing(spark):
    listed = entry.entry(spark)
    assert listed.columns == ["catalog_name", "schema_name", "object_name", "kind", "position"]
    assert listed.count() == 174


def test_wire_bytes_are_those_of_the_files(spark):
    row = entry.queries()["a11_wire_bytes"](spark, SMALL).first()
    assert row["catalog_name"] == "main" and row["files"] >= 1 and row["wire_bytes"] > 1000
