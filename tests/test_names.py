"""Filters on names that a file reader can skip by."""

import contextlib
import io
import re

import pytest
from hypothesis import given, settings, strategies as st

from ddlscope.functions.text import begins_as, folded, like_matches, like_prefixes
from ddlscope.operators import failures
from ddlscope.sources import snapshots
from pyspark.sql import functions as F
from tests.test_ranked import scanned


def plan(frame):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        frame.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("pattern,wanted", [
    ("fact_*", ["fact_"]), ("Fact_* | DIM*", ["dim", "fact_"]), ("a*|ab*|abc", ["a"]), ("x", ["x"]), ("*", None), ("a*|*b", None), ("", None),
    ("  ", None), ("a|", None), ("naïve*", ["na"]), ("é*", None), ("a*b*", ["a"]), (None, None)])
def test_prefixes(pattern, wanted):
    assert like_prefixes(pattern) == wanted


def test_no_match_is_left_out(spark):
    odd = ["ſtg_a", "STG_B", "stg_c", "Key", "KEY", "key", "İd", "ıd", "ID", "id", "i̇d", "ßx", "ssx", "ΟΔΟΣ", "οδος", "", "a\nb"]
    rows = spark.createDataFrame([(n,) for n in odd], "object_name string").withColumn("folded_name", folded("object_name"))
    for pattern in ("stg_*", "key", "id", "i*|k*", "s*", "ssx", "ßx", "ΟΔΟΣ*", "a*", "|x*", "ID|KEY|STG*"):
        matched = rows.where(like_matches("object_name", pattern))
        assert matched.where(~begins_as("folded_name", pattern)).count() == 0
    assert {r[0] for r in rows.where(like_matches("object_name", "stg_*") & begins_as("folded_name", "stg_*")).select("object_name").collect()} >= {
        "ſtg_a", "STG_B", "stg_c"}


@settings(max_examples=150, deadline=None)
@given(st.text("aAsSkKiIſKİıß* |.é", max_size=8), st.lists(st.text("aAsSkKiIſKİıßé.", max_size=5), min_size=20, max_size=40))
def test_random_filters_leave_out_no_match(spark, pattern, names):
    rows = spark.createDataFrame([(n,) for n in names], "object_name string")
    lost = rows.where(like_matches("object_name", pattern) & ~begins_as(folded("object_name"), pattern))
    assert lost.count() == 0


def test_the_reader_skips_by_name(spark, folder):
    listing = spark.range(200000).select(F.lit("c").alias("catalog_name"), F.lit("s").alias("schema_name"),
                                         F.concat(F.when(F.col("id") % 2 == 0, "Fact_").otherwise("dim_"), F.lpad(F.col("id").cast("string"), 6, "0"))
                                         .alias("object_name"), F.lit(False).alias("is_temporary"))
    path = f"{folder}/named"
    snapshots.write_by_name(listing, path, partitions=8)
    named = snapshots.tables(spark.read.parquet(path), "fact_0000* | DIM_00010*")
    text = plan(named)
    assert "Or(StringStartsWith(folded_name,dim_00010),StringStartsWith(folded_name,fact_0000))" in text
    assert named.columns == ["catalog_name", "schema_name", "object_name"]
    assert named.count() == 50 + 5 and sum(scanned(named)) < 200000 * 0.4
    everything = snapshots.tables(spark.read.parquet(path), "*_00001*")
    assert everything.count() == 10 and sum(scanned(everything)) == 200000


def test_two_distinct_counts_need_no_second_copy_of_the_rows(spark):
    rows = [("c", f"s{k % 3}", f"r{k % 5}", k % 2 == 0, "x") for k in range(60)] + [(None, "s9", "r0", True, None), ("c", None, "r9", False, "x")]
    failed = spark.createDataFrame(rows, "catalog_name string, schema_name string, reason string, permission boolean, day string")
    plain = failed.groupBy("day", "permission").agg(F.count("*").alias("failures"), F.count_distinct("reason").alias("reasons"),
                                                    F.count_distinct("catalog_name", "schema_name").alias("schemas"))
    found = failures.failure_split(failed, ["day"])
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    text = plan(found)
    assert "Expand" not in text and "Expand" in plan(plain)
    assert not re.search(r"hashpartitioning\([^)]*\breason#", text)
