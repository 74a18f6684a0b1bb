"""Exact positions in a global order, without putting a group or a table into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ddlscope.session import shared_folder


def with_position(rows: DataFrame, order: Sequence[Column], group: Sequence[str] = (),
                  position: str = "position", total: str | None = None) -> DataFrame:
    """Number the rows of each group from 1 in the given order; `total` also adds the size of the group.

    A window over the group would sort a group that holds a third of all rows in one task. Here the rows are range
    partitioned on group and order, so a large group spreads over many partitions, and each row's number is its place
    in its partition plus the sizes of the group's earlier partitions. The split points come from sampling, so the
    placed rows are checkpointed before they are counted: a lost executor must not lead to other split points.
    That is an action. Pass key columns only and join long texts afterwards. The order should be unique within the group."""
    shared_folder(rows.sparkSession)
    keys = [F.col(g) for g in group]
    placed = (rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
              .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row"))
              .checkpoint())
    # One row for each group and partition it reaches into; per group at most as many as there are partitions.
    reached = placed.groupBy("_part", *group).agg(F.count("*").alias("_rows"), F.min("_row").alias("_first"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = reached.select(
        F.col("_part").alias("_at"), *(F.col(g).alias(f"_in_{g}") for g in group), "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"), F.sum("_rows").over(whole).alias("_total"))
    # Whether these are broadcast or shuffled is for adaptive execution to decide, by their measured size.
    same = F.col("_part") == F.col("_at")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_in_{g}"))
    numbered = (F.col("_row") - F.col("_first") + F.col("_before") + 1).alias(position)
    extra = [F.col("_total").alias(total)] if total else []
    return placed.join(offsets, same).select(*rows.columns, numbered, *extra)
