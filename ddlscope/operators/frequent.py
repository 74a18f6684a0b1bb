"""The most frequent values of a column, exactly, without grouping all rows by value."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Counters of the sketch, and how many of the largest are looked into first.
COUNTERS, FIRST = 1 << 16, 64


def most_frequent(rows: DataFrame, value: str, wanted: int, count: str = "count", counters: int = COUNTERS,
                  first: int = FIRST) -> DataFrame:
    """The `wanted` most frequent values with their counts, in order; equally frequent ones by value, nulls left out.

    Where nearly every row has a value of its own, as error texts with ids in them, grouping by value would shuffle nearly every
    text. So rows are first counted by the hash of the value, in a fixed number of counters that tasks add up for themselves and
    send: a counter is never below the count of a value in it. The values in the largest counters are counted exactly, which
    gives a count that the last of the most frequent values has at least; a value with that count can only be in a counter that has
    it, too. Where there are further counters of that size, their values are counted as well; there are none as soon as the
    frequent values stand out. Only values in those counters are shuffled; if all are equally rare, that is all of them.

    The counters, bounded by their number, and the few values that are found come to the driver, so this runs jobs of its own."""
    hashed = rows.where(F.col(value).isNotNull()).select(value, F.pmod(F.xxhash64(value), F.lit(counters)).cast("int").alias("_counter"))
    sizes = dict(tuple(r) for r in hashed.groupBy("_counter").agg(F.count("*").alias("_size")).collect())
    largest = sorted(sizes, key=lambda c: (-sizes[c], c))

    def counted(some: list[int]) -> DataFrame:
        if len(some) <= first:
            kept = hashed.where(F.col("_counter").isin(some))
        else:
            chosen = rows.sparkSession.createDataFrame([(c,) for c in some], "_counter int")
            kept = hashed.join(F.broadcast(chosen), "_counter", "left_semi")
        return kept.groupBy(value).agg(F.count("*").alias(count)).orderBy(F.col(count).desc(), F.col(value)).limit(wanted)

    known = counted(largest[:first])
    found = known.collect()
    bound = found[-1][count] if len(found) == wanted else 0
    if any(sizes[c] >= bound for c in largest[first:]):
        return counted([c for k, c in enumerate(largest) if k < first or sizes[c] >= bound])
    return rows.sparkSession.createDataFrame([tuple(r) for r in found], known.schema)
