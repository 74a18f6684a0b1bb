"""The most frequent values, whatever their distribution."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ddlscope.operators import failures
from ddlscope.operators.frequent import most_frequent


def brute(values, wanted):
    counts = Counter(v for v in values if v is not None)
    return sorted(((v, n) for v, n in counts.items()), key=lambda x: (-x[1], x[0]))[:wanted]


def found(spark, values, wanted, **more):
    rows = spark.createDataFrame([(v,) for v in values], "reason string").repartition(4)
    return [tuple(r) for r in most_frequent(rows, "reason", wanted, **more).collect()]


@pytest.mark.parametrize("wanted", [1, 3, 8])
@pytest.mark.parametrize("counters,first", [(1, 1), (7, 2), (1 << 16, 64)])
def test_equals_brute_force(spark, wanted, counters, first):
    rng = random.Random(wanted * counters)
    tables = {
        "skewed": [f"r{int(rng.paretovariate(0.8))}" for _ in range(2000)],
        "flat": [f"r{k % 97}" for k in range(970)],
        "unique": [f"r{k}" for k in range(500)],
        "few": ["a", "b", "b", None, ""],
        "none": [],
        "nulls": [None] * 5,
    }
    for values in tables.values():
        assert found(spark, values, wanted, counters=counters, first=first) == brute(values, wanted)


def test_frequent_values_in_small_counters_are_not_lost(spark):
    # One heavy value for each of the counters looked into first, made of rare values there: the frequent ones are elsewhere.
    rare = [f"u{k}" for k in range(4000)]
    values = rare + [f"heavy {k}" for k in range(8) for _ in range(9 - k)]
    for first in (1, 2, 16):
        assert found(spark, values, 8, counters=64, first=first) == brute(values, 8)


def test_rare_texts_are_not_shuffled(spark):
    """With frequent reasons, the groups that are counted exactly are few, although nearly every row has a text of its own."""
    rows = spark.range(40000).select(F.when(F.col("id") % 4 == 0, F.concat(F.lit("frequent "), F.col("id") % 8))
                                     .otherwise(F.concat(F.lit("text with id "), "id")).alias("reason"))
    seen = []
    groups = type(rows).groupBy

    def noted(self, *columns):
        if columns == ("reason",):
            seen.append(self)
        return groups(self, *columns)

    type(rows).groupBy = noted
    try:
        got = [tuple(r) for r in most_frequent(rows, "reason", 2).collect()]
    finally:
        type(rows).groupBy = groups
    assert got == [("frequent 0", 5000), ("frequent 4", 5000)]
    assert len(seen) == 1 and seen[0].distinct().count() < 400


def test_report_with_long_and_equal_reasons(spark):
    schema = "attempt_id bigint, run_id bigint, schema_name string, object_name string, reason string, kind string"
    rows = [(k, 1, "s", f"o{k}", f"{'x' * 700}{k % 12:02}", "TABLE") for k in range(60)]
    got = failures.failure_groups(failures.failures(spark.createDataFrame(rows, schema)), ["attempt_id"]).orderBy("place").collect()
    assert [(r["place"], r["failures"], r["reason"], r["examples"]) for r in got] == [
        (k + 1, 5, "x" * 600, f"s.o{k}, s.o{k + 12}, s.o{k + 24}") for k in range(8)]
