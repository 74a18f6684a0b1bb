"""Selection of objects: search, counts, and changes to the selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ddlscope.functions.text import search_matches
from ddlscope.schemas import KEYS, SCHEMA_KEYS


def with_selection(objects: DataFrame, selection: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """Add whether each object is selected; one without a choice is not."""
    return (objects.join(selection.select(*lead, *KEYS, "selected"), [*lead, *KEYS], "left")
            .withColumn("selected", F.coalesce("selected", F.lit(False))))


def matches(objects: DataFrame, query: str | None) -> DataFrame:
    """Objects whose `schema.name kind` contains the searched text."""
    return objects.where(search_matches(query))


def select_where(selected: DataFrame, condition: Column, value: bool = True, lead: Sequence[str] = ()) -> DataFrame:
    """A new selection: the objects that meet the condition get the value, the others keep theirs."""
    choice = F.when(condition, F.lit(value)).otherwise(F.col("selected")).alias("selected")
    return selected.select(*lead, *KEYS, choice)


def _counts():
    return F.count_if("selected").alias("selected"), F.count("*").alias("total")


def selection_counts(selected: DataFrame, lead: Sequence[str] = ("catalog_name",)) -> DataFrame:
    return selected.groupBy(*lead).agg(*_counts())


def schema_counts(selected: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    return selected.groupBy(*lead, *SCHEMA_KEYS).agg(*_counts())


def page_schema_counts(selected: DataFrame, page: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """Counts of the schemas that occur on a page, over all matches and not only those on the page."""
    keys = [*lead, *SCHEMA_KEYS]
    return schema_counts(selected, lead).join(page.select(*keys).distinct(), keys, "left_semi")


def to_export(selected: DataFrame) -> DataFrame:
    """Selected objects whose DDL is there."""
    return selected.where(F.col("selected") & (F.col("ddl") != ""))


def to_generate(selected: DataFrame) -> DataFrame:
    """Selected objects whose DDL is still missing; running it again resumes the work. Against a table of what has been
    generated so far, `outcomes.without` leaves the same objects and reads no text."""
    return selected.where(F.col("selected") & F.col("ddl").isNull())
