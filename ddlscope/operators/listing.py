"""Object listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ddlscope.functions.errors import first_line
from ddlscope.fixed import SKIPPED_REASON_CHARS, SKIPPED_SCHEMAS
from ddlscope.schemas import KEYS, SCHEMA_KEYS
from ddlscope.sources import snapshots


def view_kinds(views: DataFrame, lead: Sequence[str] = (), arrival: str | None = None) -> DataFrame:
    """One row for each view. Of a repeated name the last one counts, by `arrival` if the listing has such a column.
    What is aggregated is a flag and not the kind's text, so that tasks can do it by hashing."""
    is_materialized = F.col("kind") == "MATERIALIZED VIEW"
    last = F.max_by(is_materialized, arrival) if arrival else F.max(is_materialized)
    kind = F.when(F.col("_materialized"), "MATERIALIZED VIEW").otherwise("VIEW")
    return views.groupBy(*lead, *KEYS).agg(last.alias("_materialized")).select(*lead, *KEYS, kind.alias("view_kind"))


def with_view_kinds(tables: DataFrame, views: DataFrame, lead: Sequence[str] = (),
                    arrival: str | None = None) -> DataFrame:
    """Kind of each listed table: that of the view of exactly its name, else TABLE."""
    return (tables.join(view_kinds(views, lead, arrival), [*lead, *KEYS], "left")
            .withColumn("kind", F.coalesce("view_kind", F.lit("TABLE"))).drop("view_kind"))


def _split_on_streaming(tables: DataFrame, streaming: DataFrame, how: str, lead: Sequence[str]) -> DataFrame:
    keys = [*lead, *SCHEMA_KEYS, "lower_name"]
    return tables.withColumn("lower_name", F.lower("object_name")).join(streaming, keys, how).drop("lower_name")


def without_streaming(tables: DataFrame, streaming: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """Streaming tables match by lower-cased name."""
    return _split_on_streaming(tables, streaming, "left_anti", lead)


def streaming_only(tables: DataFrame, streaming: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """The listed objects that are left out because they are streaming tables."""
    return _split_on_streaming(tables, streaming, "left_semi", lead).withColumn("kind", F.lit("STREAMING TABLE"))


def list_objects(tables: DataFrame, views: DataFrame, streaming: DataFrame, pattern: str = "",
                 want_tables: bool = True, want_views: bool = True, lead: Sequence[str] = (),
                 arrival: str | None = None) -> DataFrame:
    """All objects of all schemas in one job: listed, not temporary, not streaming tables, of the wanted families.
    `tables` and `views` are raw listings. Streaming tables are looked for only when tables are wanted. Both joins are
    on the name and what holds it, so no catalog or schema, however large, ends up in one task."""
    listed = snapshots.tables(tables, pattern)
    if want_tables:
        listed = without_streaming(listed, streaming, lead)
    listed = with_view_kinds(listed, snapshots.views(views, pattern), lead, arrival)
    return (listed.where(snapshots.wanted_family(want_tables, want_views))
            .select(*lead, *KEYS, "kind"))


def object_records(listing: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """Object records before any DDL has been generated."""
    return listing.select(*lead, *KEYS, "kind", F.lit(None).cast("string").alias("ddl"))


def listed_schemas_only(listing: DataFrame, status: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """Objects of the schemas that could be listed; a schema that failed is skipped and the rest go on."""
    failed = status.where(F.col("reason").isNotNull()).select(*lead, *SCHEMA_KEYS).distinct()
    return listing.join(failed, [*lead, *SCHEMA_KEYS], "left_anti")


def listing_summary(listing: DataFrame, status: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """For each catalog of the status or of the listing: schemas asked for, schemas that failed, objects found."""
    keys = [*lead, "catalog_name"]
    schemas = status.groupBy(*keys).agg(F.count("*").alias("schemas"), F.count("reason").alias("failed_schemas"))
    objects = listing.groupBy(*keys).agg(F.count("*").alias("objects"))
    return schemas.join(objects, keys, "full").fillna(0, ["schemas", "failed_schemas", "objects"])


def excluded_counts(excluded: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    return excluded.groupBy(*lead, *SCHEMA_KEYS, "kind").agg(F.count("*").alias("excluded"))


def skipped_schemas(status: DataFrame, lead: Sequence[str] = (), shown: int = SKIPPED_SCHEMAS) -> DataFrame:
    """Report for each listing of a catalog: the first schemas that failed, with the start of the reason, and how many more
    did. Tasks send no more than `shown` rows of a catalog."""
    keys = [*lead, "catalog_name"]
    reason = F.substring(first_line("reason"), 1, SKIPPED_REASON_CHARS).alias("reason")
    failed = status.where(F.col("reason").isNotNull())
    first = (failed.select(*lead, *SCHEMA_KEYS, reason)
             .withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy("schema_name", "reason")))
             .where(F.col("_place") <= shown).drop("_place"))
    counts = failed.groupBy(*keys).agg(F.greatest(F.count("*") - shown, F.lit(0)).alias("more"))
    return first.join(counts, keys)
