"""DDL results joined back to the listing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ddlscope.functions.ddl import kind_from_ddl
from ddlscope.schemas import KEYS
from ddlscope.sources.snapshots import is_unsupported


def latest_ddl(results: DataFrame, arrival: str, lead: Sequence[str] = ()) -> DataFrame:
    """The last text of each object, for logs that hold several. `arrival` is unique for an object. No text is aggregated: the
    last arrival is found by keys, and its text joined."""
    texts = results.where(F.col("ddl").isNotNull()).select(*lead, *KEYS, arrival, "ddl")
    last = texts.groupBy(*lead, *KEYS).agg(F.max(arrival).alias(arrival))
    return texts.join(last, [*lead, *KEYS, arrival], "left_semi").drop(arrival)


def write_back(listing: DataFrame, ddl: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """Add the DDL to each listed object and take the kind from it where it names one. `ddl` has one row per object.
    The kind is read off before the join, so a job that needs no text moves only the kind."""
    texts = ddl.select(*lead, *KEYS, "ddl", kind_from_ddl("ddl").alias("ddl_kind"))
    return (listing.select(*lead, *KEYS, "kind").join(texts, [*lead, *KEYS], "left")
            .withColumn("kind", F.coalesce("ddl_kind", "kind")).drop("ddl_kind"))


def supported(objects: DataFrame) -> DataFrame:
    return objects.where(~is_unsupported())


def unsupported(objects: DataFrame) -> DataFrame:
    return objects.where(is_unsupported())


def without(rows: DataFrame, dropped: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """Objects, or a selection of them, without the dropped ones."""
    return rows.join(dropped.select(*lead, *KEYS), [*lead, *KEYS], "left_anti")
