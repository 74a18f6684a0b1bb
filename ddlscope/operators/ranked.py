"""Rows stored in a global order with a directory of ranks, so that places and pages need no further sort.

`store` sorts once: the rows are range-partitioned on group and order and written with the part they fell into and their place in
it, each part in a folder of its own. The directory has a row for each part and group that meet: how many rows, the first
place, the rows of the group in earlier parts, the size of the group, and the keys of the first and the last row. It
has no more rows than there are parts and groups together. With it a row's position in its group is a sum of two numbers, and
a page is in one or two parts, which alone are opened, however far on it is."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ddlscope.operators.paging import page_count


def store(rows: DataFrame, path: str, order: Sequence[Column], group: Sequence[str] = (), keys: Sequence[str] = (),
          partitions: int | None = None) -> Ranked:
    """Write the rows in order, and their directory. The order should be unique within the group; a null group value is a group.
    `keys` are the columns that the directory has of the first and the last row of a part."""
    by = [*(F.col(g) for g in group), *order]
    spread = rows.repartitionByRange(partitions, *by) if partitions else rows.repartitionByRange(*by)
    # The part is known before the sort, so that the writer, which wants rows sorted by folder, need not sort again.
    parts = spread.withColumn("_part", F.spark_partition_id()).sortWithinPartitions("_part", *by)
    placed = parts.withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    placed.write.partitionBy("_part").parquet(f"{path}/rows")
    spark = rows.sparkSession
    written = spark.read.schema(placed.schema).parquet(f"{path}/rows")
    ends = [f(F.struct(*keys), "_place").alias(n) for f, n in ((F.min_by, "first_keys"), (F.max_by, "last_keys"))] if keys else []
    met = written.groupBy(*group, "_part").agg(F.count("*").alias("rows"), F.min("_place").alias("first_place"), *ends)
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    (met.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).withColumn("total", F.sum("rows").over(whole))
     .coalesce(1).write.parquet(f"{path}/directory"))
    return Ranked(spark, path, tuple(group), rows.schema)


@dataclass(frozen=True)
class Ranked:
    """Stored rows: what `store` returns, or made anew from the path, the group columns and the schema of the rows."""

    spark: SparkSession
    path: str
    group: tuple[str, ...]
    schema: StructType

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def rows(self) -> DataFrame:
        """The rows, with the part they are in and their place in it."""
        whole = StructType([*self.schema.fields, StructField("_place", LongType()), StructField("_part", IntegerType())])
        return self.spark.read.schema(whole).parquet(f"{self.path}/rows")

    def directory(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/directory")

    def _joined(self, directory: DataFrame) -> DataFrame:
        """Rows with the directory's row of their part and group."""
        own = directory.withColumnsRenamed({c: f"_of_{c}" for c in (*self.group, "_part")})
        same = F.col("_part") == F.col("_of__part")
        for g in self.group:
            same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
        return self.rows().join(own, same)

    def _position(self) -> Column:
        return F.col("_place") - F.col("first_place") + F.col("before") + 1

    def positions(self, position: str = "position", total: str | None = None) -> DataFrame:
        """All rows with their position in their group, from 1; `total` adds the size of the group. Nothing is sorted."""
        more = [F.col("total").alias(total)] if total else []
        return self._joined(self.directory()).select(*self.columns, self._position().alias(position), *more)

    def page(self, index: int, size: int) -> DataFrame:
        """The rows on one page of each group, with `position` and `page`; an index beyond the ends means the first or last page. The
        directory says which parts such a page reaches into; where it is small enough to be broadcast, Spark opens only these."""
        last = page_count(F.col("total"), size) - 1
        shown = self.directory().withColumn("page", F.least(F.greatest(F.lit(index), F.lit(0)), last).cast("bigint"))
        first = F.col("page") * size
        reached = shown.where((F.col("before") < first + size) & (F.col("before") + F.col("rows") > first))
        found = self._joined(reached).withColumn("position", self._position())
        return found.where((F.col("position") > first) & (F.col("position") <= first + size)).select(*self.columns, "position", "page")

    def page_of(self, values: Sequence, index: int, size: int) -> DataFrame:
        """The rows on one page of one group, named by its values, with `position` and `page`. The directory's rows of the page, two
        as a rule, come to the driver; the reader gets the parts and the places in them as filters."""
        same = F.lit(True)
        for g, v in zip(self.group, values, strict=True):
            same = same & F.col(g).eqNullSafe(F.lit(v))
        of_group = self.directory().where(same)
        whole = of_group.agg(F.max("total")).first()[0] or 0
        page = min(max(index, 0), max(-(-whole // size), 1) - 1)
        low, high = page * size, (page + 1) * size
        reached = of_group.where((F.col("before") < high) & (F.col("before") + F.col("rows") > low)).orderBy("_part").collect()
        wanted, position = F.lit(False), F.lit(None).cast("bigint")
        for r in reached:
            shift = r["first_place"] - r["before"]
            here = (F.col("_part") == r["_part"]) & (F.col("_place") >= low + shift) & (F.col("_place") < high + shift)
            wanted, position = wanted | here, F.when(F.col("_part") == r["_part"], F.col("_place") - shift + 1).otherwise(position)
        return self.rows().where(same & wanted).select(*self.columns, position.alias("position"), F.lit(page).cast("bigint").alias("page"))
