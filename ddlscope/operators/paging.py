"""Pages of a listing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ddlscope.fixed import DEFAULT_PAGE_SIZE
from ddlscope.functions.text import listing_order
from ddlscope.operators.positions import with_position

_GROUP = ("catalog_name",)


def page_count(rows: Column, size: int) -> Column:
    """Pages needed for the rows, at least one."""
    return F.greatest(F.ceil(rows / F.lit(size)), F.lit(1)).cast("bigint")


def paginate(matches: DataFrame, size: int = DEFAULT_PAGE_SIZE, group: Sequence[str] = _GROUP) -> DataFrame:
    """Add each match's page (from 0), the number of pages, and the rows `first_row` to `last_row` of `matches` that
    the page shows. The listing of every group starts its own pages."""
    placed = with_position(matches, listing_order(), group, total="matches")
    first = F.col("page") * size + 1
    return (placed.withColumn("page", F.floor((F.col("position") - 1) / F.lit(size)).cast("bigint"))
            .withColumn("pages", page_count(F.col("matches"), size))
            .withColumn("first_row", first)
            .withColumn("last_row", F.least(first + (size - 1), F.col("matches"))))


def on_page(index: int) -> Column:
    """Whether a paginated row is on the page asked for; an index beyond the ends means the first or last page."""
    return F.col("page") == F.least(F.greatest(F.lit(index), F.lit(0)), F.col("pages") - 1)


def one_page(matches: DataFrame, index: int = 0, size: int = DEFAULT_PAGE_SIZE, group: Sequence[str] = _GROUP) -> DataFrame:
    """The rows on one page of each group, with `position` and `page`, without placing the others: each task sends the rows of a
    group up to the end of the page asked for. An index beyond the ends means the first or last page; a group that ends
    before the page has all of its rows among those. For pages far on, `paginate` spreads the work."""
    index = max(index, 0)
    upto = F.row_number().over(Window.partitionBy(*group).orderBy(*listing_order()))
    first = matches.withColumn("position", upto.cast("bigint")).where(F.col("position") <= (index + 1) * size)
    pages = matches.groupBy(*group).agg(F.least(F.lit(index), page_count(F.count("*"), size) - 1).alias("page"))
    return first.join(pages, list(group)).where(F.floor((F.col("position") - 1) / F.lit(size)) == F.col("page"))


def page_summary(groups: DataFrame, matches: DataFrame, index: int = 0, size: int = DEFAULT_PAGE_SIZE,
                 group: Sequence[str] = _GROUP) -> DataFrame:
    """For each group, also one without matches: matches, pages, the page shown, and its first and last row."""
    counted = matches.groupBy(*group).agg(F.count("*").alias("matches"))
    summary = (groups.select(*group).distinct().join(counted, list(group), "left")
               .withColumn("matches", F.coalesce("matches", F.lit(0)))
               .withColumn("pages", page_count(F.col("matches"), size))
               .withColumn("page", F.least(F.greatest(F.lit(index), F.lit(0)), F.col("pages") - 1)))
    first = F.col("page") * size + 1
    return (summary.withColumn("first_row", F.when(F.col("matches") > 0, first).otherwise(0))
            .withColumn("last_row", F.least(first + (size - 1), F.col("matches"))))
