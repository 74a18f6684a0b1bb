"""Packing of ordered texts into payloads of a bounded size, by prefix sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ddlscope.session import shared_folder


def packed(sizes: DataFrame, limit: int, order: Sequence[Column], group: Sequence[str] = ("catalog_name",), size: str = "bytes") -> DataFrame:
    """The rows, each with a text's `size` in bytes, with the payload of their group that the text goes into: `section` and `piece`, which
    order the payloads, and `position`, its place in the group. Texts in a payload are joined by a line feed and follow each other in
    `order`, which is unique in the group. No payload has more bytes than the limit, unless it is a single text that has.

    A text of more than half the limit is a payload of its own and ends a section. Within a section the texts are cut where
    their starts pass a multiple of half the limit: what starts in one half is at most one half longer. A start is a sum of
    what is before it; the rows are range-partitioned in order, and the sums of the earlier partitions, a few numbers for each
    partition and group, are added to those within one. So a group that holds most of the rows is spread over many tasks. The split
    points come from sampling, so the rows are checkpointed before they are summed, which is an action: pass keys and sizes, and join
    the texts afterwards."""
    shared_folder(sizes.sparkSession)
    by = [*(F.col(g) for g in group), *order]
    half = limit // 2
    placed = (sizes.repartitionByRange(*by).sortWithinPartitions(*by)
              .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row")).checkpoint())
    is_large = F.col(size) > half
    taken = F.col(size).cast("bigint") + 1
    inner = Window.partitionBy(*group, "_part").orderBy("_row")
    summed = placed.select("*", is_large.alias("_large"), F.sum(taken).over(inner).alias("_end"), F.row_number().over(inner).alias("_nth"),
                           F.count_if(is_large).over(inner).alias("_larges"))
    # Where the last large text at or before a row ends, within its partition.
    last = F.max(F.when(F.col("_large"), F.col("_end"))).over(inner)
    summed = summed.withColumn("_last_end", last)
    parts = summed.groupBy(*group, "_part").agg(F.max("_end").alias("_bytes"), F.max("_nth").alias("_rows"), F.max("_larges").alias("_of_larges"),
                                                F.max("_last_end").alias("_inner_last"))
    # One row for each partition and group that meet.
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)

    def before(column: str) -> Column:
        return F.coalesce(F.sum(column).over(earlier), F.lit(0))

    offsets = parts.withColumns({"_bytes_before": before("_bytes"), "_rows_before": before("_rows"), "_larges_before": before("_of_larges")})
    offsets = offsets.withColumn("_last_before", F.coalesce(F.max(F.col("_inner_last") + F.col("_bytes_before")).over(earlier), F.lit(0)))
    offsets = offsets.select(*(F.col(g).alias(f"_in_{g}") for g in group), F.col("_part").alias("_at"), "_bytes_before", "_rows_before",
                             "_larges_before", "_last_before")
    same = F.col("_part") == F.col("_at")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_in_{g}"))
    joined = summed.join(offsets, same)
    # Of a large text itself, the section is that of the texts before it, and its piece comes after all of theirs.
    section = F.col("_larges_before") + F.col("_larges") - F.col("_large").cast("int")
    own_last = F.greatest(F.coalesce(F.col("_last_end") + F.col("_bytes_before"), F.lit(0)), F.col("_last_before"))
    start = F.col("_end") + F.col("_bytes_before") - taken - own_last
    piece = F.when(F.col("_large"), F.lit(None)).otherwise(F.floor(start / F.lit(half)))
    return joined.select(*sizes.columns, section.cast("bigint").alias("section"), piece.cast("bigint").alias("piece"),
                         (F.col("_rows_before") + F.col("_nth")).cast("bigint").alias("position"))
