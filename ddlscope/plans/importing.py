"""From snapshots to an export: list, bring in the DDL, select, write. Every step is one lazy plan over all catalogs
of the snapshot; only `export` runs a job of its own, because it writes files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ddlscope.fixed import RAW_LIMIT_BYTES, WIRE_LIMIT_BYTES
from ddlscope.functions.sizes import size_verdict
from ddlscope.functions.text import like_matches
from ddlscope.operators import catalogs, failures, listing, outcomes, selection
from ddlscope.schemas import KEYS
from ddlscope.session import apply_settings
from ddlscope.sinks import payload
from ddlscope.sources import snapshots


@dataclass(frozen=True)
class Snapshot:
    """The tables of one snapshot, or of many when all of them carry the `lead` columns."""

    tables: DataFrame
    views: DataFrame
    information: DataFrame
    properties: DataFrame
    schema_status: DataFrame
    ddl: DataFrame
    selection: DataFrame
    lead: Sequence[str] = ()
    # The column that says which row of a repeated view, or of a repeated text, came last, if they can repeat.
    view_arrival: str | None = None
    ddl_arrival: str | None = None

    def texts(self) -> DataFrame:
        """One text for each object."""
        return outcomes.latest_ddl(self.ddl, self.ddl_arrival, self.lead) if self.ddl_arrival else self.ddl

    def streaming(self) -> DataFrame:
        described = snapshots.catalog_properties(self.properties, self.lead)
        return snapshots.streaming_table_names(
            self.information, catalogs.foreign_catalogs(described, self.lead), self.lead)


def list_objects(snapshot: Snapshot, schema_pattern: str = "", pattern: str = "", want_tables: bool = True,
                 want_views: bool = True) -> DataFrame:
    """Objects of the schemas that match and could be listed. Schemas are left out at the scans of the listings, before
    the joins by name: what follows a join by schema would otherwise keep its partitioning, large schemas and all."""
    apply_settings(snapshot.tables.sparkSession)
    in_schemas = like_matches("schema_name", schema_pattern)
    tables = listing.listed_schemas_only(snapshot.tables.where(in_schemas), snapshot.schema_status, snapshot.lead)
    return listing.list_objects(tables, snapshot.views.where(in_schemas), snapshot.streaming(), pattern, want_tables,
                                want_views, snapshot.lead, snapshot.view_arrival)


def resolve(snapshot: Snapshot, listed: DataFrame) -> DataFrame:
    """Listed objects with their DDL, exact kind and selection, without the kinds that are not exported."""
    known = outcomes.supported(outcomes.write_back(listed, snapshot.texts(), snapshot.lead))
    return selection.with_selection(known, snapshot.selection, snapshot.lead)


def sample_access(snapshot: Snapshot, listed: DataFrame) -> DataFrame:
    """The first object of each schema with its DDL, null where it could not be read."""
    return outcomes.write_back(failures.access_sample(listed, snapshot.lead), snapshot.texts(), snapshot.lead)


@dataclass(frozen=True)
class AccessCheck:
    """What samples of each schema say about read access."""

    # Failures of samples with `permission`; their numbers; schemas that are denied, the objects in them, the grants that
    # would help; and for each catalog its schemas, how many are denied, whether all are, and the objects affected.
    failed: DataFrame
    split: DataFrame
    denied: DataFrame
    affected: DataFrame
    grants: DataFrame
    catalogs: DataFrame


def access_check(listed: DataFrame, outcomes_: DataFrame, principal: str, lead: Sequence[str] = ()) -> AccessCheck:
    """The first object of each schema stands for it; `outcomes_` says by key with what `reason` reading it failed, if it did."""
    keys = [*lead, *KEYS]
    tried = failures.access_sample(listed, lead).join(outcomes_.select(*keys, "reason"), keys, "left")
    failed = failures.failures(tried)
    denied = failures.denied_schemas(failed, lead)
    affected = failures.objects_in(listed, denied, lead)
    counts = affected.groupBy(*lead, "catalog_name").agg(F.count("*").alias("affected"))
    catalogs_ = failures.fully_denied_catalogs(listed, denied, lead).join(counts, [*lead, "catalog_name"], "left").fillna(0, ["affected"])
    return AccessCheck(failed, failures.failure_split(failed, lead), denied, affected, failures.grants(denied, principal, lead), catalogs_)


def export(resolved: DataFrame, path: str, keep_catalog: bool = False, raw_limit: int = RAW_LIMIT_BYTES,
           wire_limit: int = WIRE_LIMIT_BYTES, envelope_bytes: int = 0, lead: Sequence[str] = (),
           partitions: int | None = None) -> DataFrame:
    """Write the selected objects' payloads and return, for each catalog of each snapshot, their sizes and two verdicts: of the
    preview, on the text, and of the submission, on the body and its compressed size. `lead` columns become folders and come
    back as text, as the catalog does; a null or empty name is null. Sizes come from the files."""
    objects, spark = selection.to_export(resolved), resolved.sparkSession
    payload.write_payload(objects, path, keep_catalog, lead=lead, partitions=partitions)
    keys = [*lead, "catalog_name"]
    counted = objects.groupBy(*(F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in keys)).agg(F.count("*").alias("objects"))
    sizes = [payload.text_sizes(spark, path, envelope_bytes, lead), payload.wire_sizes(spark, path, lead)]
    for more in sizes:
        other = more.select(*(F.col(c).alias(f"_{c}") for c in keys), *(c for c in more.columns if c not in keys))
        same = F.lit(True)
        for c in keys:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        counted = counted.join(other, same, "left").drop(*(f"_{c}" for c in keys))
    return counted.withColumns({"preview_verdict": size_verdict("raw_bytes", None, raw_limit),
                                "submit_verdict": size_verdict("body_bytes", "wire_bytes", raw_limit, wire_limit)})
