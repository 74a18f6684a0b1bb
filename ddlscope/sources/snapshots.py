"""Scans of catalog snapshots. A scan only selects, filters and derives columns, so that both reach the file reader;
sorting is left to the outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ddlscope.fixed import HIVE_CATALOGS, UNSUPPORTED_KINDS
from ddlscope.functions.ddl import kind_from_table_type
from ddlscope.functions.text import begins_as, folded, like_matches, normalized, trimmed


def read_snapshot(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet snapshot with its declared schema; partition columns beyond it, such as a date, are kept."""
    return spark.read.schema(schema).parquet(path)


#: Column of a snapshot that is sorted by name.
FOLDED = "folded_name"


def write_by_name(listing: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write a listing sorted by folded name, with that as a further column, `folded_name`. The scans of `tables` and `views` then ask
    the reader for the names that can match only, and it skips files and row groups by their least and greatest name. A schema
    or catalog, however large, is spread over the files."""
    named = listing.withColumn(FOLDED, folded("object_name"))
    order = [FOLDED, *(c for c in ("catalog_name", "schema_name", "object_name") if c in listing.columns)]
    spread = named.repartitionByRange(partitions, *order) if partitions else named.repartitionByRange(*order)
    spread.sortWithinPartitions(*order).write.parquet(path)


def name_matches(listing: DataFrame, pattern: str) -> Column:
    """Whether the object's name matches the filter; a listing sorted by name is also asked for what the name begins with."""
    matches = like_matches("object_name", pattern)
    return begins_as(FOLDED, pattern) & matches if FOLDED in listing.columns else matches


def catalog_names(listing: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """The catalogs that occur in a listing."""
    return listing.select(*lead, "catalog_name").distinct()


def catalog_properties(properties: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """Catalog type and connection out of key/value rows. Where a key repeats, the greatest value is taken."""
    key = normalized("k")
    value = F.coalesce(trimmed("v"), F.lit(""))
    return properties.groupBy(*lead, "catalog_name").agg(
        F.coalesce(F.max(F.when(key == "catalog type", F.upper(value))), F.lit("")).alias("catalog_type"),
        F.nullif(F.max(F.when(key == "connection name", value)), F.lit("")).alias("connection_name"))


def connections(listing: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """Connection attributes; what is not visible reads as empty."""
    return listing.select(*lead, "connection_name", *(
        F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("connection_type", "host", "port")))


def schema_names(listing: DataFrame, pattern: str = "", lead: Sequence[str] = ()) -> DataFrame:
    """The schemas of a listing whose name matches the filter."""
    return (listing.select(*lead, "catalog_name", "schema_name")
            .where(like_matches("schema_name", pattern)).distinct())


def tables(listing: DataFrame, pattern: str = "") -> DataFrame:
    """Tables and views as they are listed, without temporary ones."""
    return listing.where(permanent() & name_matches(listing, pattern)).drop("is_temporary", FOLDED)


def views(listing: DataFrame, pattern: str = "") -> DataFrame:
    """Views that are not temporary, with their kind; a missing flag reads as not materialized."""
    kind = F.when(F.col("is_materialized"), "MATERIALIZED VIEW").otherwise("VIEW")
    return (listing.where(permanent() & name_matches(listing, pattern))
            .withColumn("kind", kind).drop("is_temporary", "is_materialized", FOLDED))


def streaming_table_names(information: DataFrame, foreign: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """Lower-cased names of streaming tables; none are looked for in foreign catalogs and in the Hive names. A name may
    come twice, which the semi and anti joins on them do not mind."""
    wanted = (F.col("table_type") == "STREAMING_TABLE") & ~F.lower("catalog_name").isin(*HIVE_CATALOGS)
    return (information.where(wanted)
            .join(foreign.select(*lead, "catalog_name"), [*lead, "catalog_name"], "left_anti")
            .select(*lead, "catalog_name", F.col("table_schema").alias("schema_name"),
                    F.lower("table_name").alias("lower_name")))


def typed_listing(listing: DataFrame, want_tables: bool = True, want_views: bool = True) -> DataFrame:
    """Listing out of rows that carry a table type; the name filter does not apply to it."""
    typed = listing.withColumn("kind", kind_from_table_type("table_type"))
    return (typed.where(~is_unsupported() & permanent() & wanted_family(want_tables, want_views))
            .drop("table_type", "is_temporary"))


def typed_listing_excluded(listing: DataFrame) -> DataFrame:
    """The rows `typed_listing` leaves out because of their kind; these include temporary ones."""
    return listing.withColumn("kind", kind_from_table_type("table_type")).where(is_unsupported())


def ddl_texts(snapshot: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """`CREATE` statements by object, null where none has been generated."""
    return snapshot.select(*lead, "catalog_name", "schema_name", "object_name", "ddl")


def permanent() -> Column:
    """Not temporary; a missing flag means not. Written so that the file reader can apply it."""
    return F.col("is_temporary").isNull() | (F.col("is_temporary") == F.lit(False))


def wanted_family(want_tables: bool, want_views: bool, kind: str = "kind") -> Column:
    """Whether the family of the kind, views or tables, is asked for."""
    return F.when(F.col(kind).contains("VIEW"), F.lit(want_views)).otherwise(F.lit(want_tables))


def is_unsupported(kind: str = "kind") -> Column:
    return F.coalesce(F.col(kind).isin(*UNSUPPORTED_KINDS), F.lit(False))
