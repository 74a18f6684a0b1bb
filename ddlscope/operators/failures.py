"""Failures grouped by reason, and what missing read access they show."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ddlscope.fixed import EXAMPLES_PER_GROUP, FAILURE_GROUPS, NAMED_SCHEMAS, REASON_CHARS
from ddlscope.functions.errors import is_permission_error
from ddlscope.functions.text import label, listing_order, quoted
from ddlscope.operators.frequent import most_frequent
from ddlscope.schemas import SCHEMA_KEYS


def failures(outcomes: DataFrame) -> DataFrame:
    """Outcomes with a reason, split into missing permission and all else. A cancelled one is no failure."""
    return (outcomes.where(F.col("reason").isNotNull() & (F.col("reason") != "cancelled"))
            .withColumn("permission", is_permission_error("reason")))


def failure_groups(failed: DataFrame, order: Sequence[str | Column], within: Sequence[str] = ()) -> DataFrame:
    """The most frequent reasons, with their counts and the first objects that met them, in `order` of arrival.
    `within` reports them separately, for instance by `permission` or by run.

    The reasons of a report over all failures are found without grouping by every text (`frequent`), and broadcast. A task
    passes on no more than the first few rows of a reason, so one reason may hold most failures. That needs rows that are not
    partitioned by reason yet: they are reduced before they are joined to the counts."""
    most = [F.col("failures").desc(), F.col("reason")]
    keys = [*within, "reason"]
    if within:
        counted = failed.groupBy(*keys).agg(F.count("*").alias("failures"))
        place = F.row_number().over(Window.partitionBy(*within).orderBy(*most))
        top = counted.withColumn("place", place).where(F.col("place") <= FAILURE_GROUPS)
    else:
        # The window and the broadcast see the few rows that the limit leaves.
        top = most_frequent(failed, "reason", FAILURE_GROUPS, "failures").withColumn("place", F.row_number().over(Window.orderBy(*most)))
        failed = failed.join(F.broadcast(top.select(*keys)), keys, "left_semi")
    arrival = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    first = (failed.withColumn("nth", arrival).where(F.col("nth") <= EXAMPLES_PER_GROUP)
             .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("nth", label().alias("object")))).alias("first")))
    return (top.join(first, keys)
            .select(*within, "place", "failures", F.substring("reason", 1, REASON_CHARS).alias("reason"),
                    F.array_join("first.object", ", ").alias("examples")))


def group_states(failed: DataFrame, order: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """For every reason how often it occurs and the first objects that met it, in `order` of arrival: a state that can be merged
    with that of other failures (`merged_groups`). Tasks send partial counts and no more than the first few rows of a reason."""
    keys = [*within, "reason"]
    counted = failed.groupBy(*keys).agg(F.count("*").alias("failures"))
    arrival = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    first = (failed.withColumn("nth", arrival).where(F.col("nth") <= EXAMPLES_PER_GROUP)
             .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*order, label().alias("object")))).alias("first")))
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    return counted.join(first.withColumnsRenamed({k: f"_{k}" for k in keys}), same).select(*keys, "failures", "first")


def merged_groups(states: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """States of several sets of failures as that of all of them. What is collected of a reason is a few objects of each set."""
    first = F.slice(F.sort_array(F.flatten(F.collect_list("first"))), 1, EXAMPLES_PER_GROUP)
    return states.groupBy(*within, "reason").agg(F.sum("failures").alias("failures"), first.alias("first"))


def top_groups(states: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """The report of `failure_groups` from the states of all reasons."""
    most = [F.col("failures").desc(), F.col("reason")]
    if within:
        place = F.row_number().over(Window.partitionBy(*within).orderBy(*most))
        top = states.withColumn("place", place).where(F.col("place") <= FAILURE_GROUPS)
    else:
        top = states.orderBy(*most).limit(FAILURE_GROUPS).withColumn("place", F.row_number().over(Window.orderBy(*most)))
    return top.select(*within, "place", "failures", F.substring("reason", 1, REASON_CHARS).alias("reason"),
                      F.array_join("first.object", ", ").alias("examples"))


def failure_split(failed: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """Failures, reasons and schemas, by whether permission is what is missing.

    Both distinct counts come from one aggregate by reason and schema, of which tasks send partial counts; two distinct counts in
    one aggregate would double every row. A reason goes by its digest, so that no text is shuffled."""
    keys, schema = [*lead, "permission"], F.when(F.col("catalog_name").isNotNull() & F.col("schema_name").isNotNull(), F.struct(*SCHEMA_KEYS))
    reason = F.unhex(F.sha2(F.col("reason").cast("binary"), 256)).alias("_reason")
    met = failed.groupBy(*keys, reason, schema.alias("_schema")).agg(F.count("*").alias("_failures"))
    nothing = F.lit(0).cast("bigint")
    # Both sides use the sums, so that they want the same columns and the aggregate is made once.
    reasons = met.groupBy(*keys, "_reason").agg(F.sum("_failures").alias("_failures")).select(
        *keys, "_failures", F.col("_reason").isNotNull().cast("bigint").alias("_reasons"), nothing.alias("_schemas"))
    schemas = met.groupBy(*keys, "_schema").agg(F.sum("_failures").alias("_failures")).select(
        *keys, nothing.alias("_failures"), nothing.alias("_reasons"), (F.col("_schema").isNotNull() & (F.col("_failures") > 0)).cast("bigint").alias("_schemas"))
    return reasons.union(schemas).groupBy(*keys).agg(*(F.sum(f"_{c}").alias(c) for c in ("failures", "reasons", "schemas")))


def denied_schemas(failed: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """Schemas in which permission is missing, taken from the key columns, so names may hold dots."""
    return failed.where("permission").select(*lead, *SCHEMA_KEYS).distinct()


def objects_in(objects: DataFrame, schemas: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """Objects in the given schemas."""
    keys = [*lead, *SCHEMA_KEYS]
    return objects.join(schemas.select(*keys), keys, "left_semi")


def fully_denied_catalogs(objects: DataFrame, denied: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """For each catalog with objects: its schemas, how many are denied, and whether that is all of them."""
    keys = [*lead, *SCHEMA_KEYS]
    flagged = (objects.select(*keys).distinct()
               .join(denied.select(*keys).distinct().withColumn("denied", F.lit(True)), keys, "left"))
    return (flagged.groupBy(*lead, "catalog_name")
            .agg(F.count("*").alias("schemas"), F.count("denied").alias("denied_schemas"))
            .withColumn("all_denied", F.col("schemas") == F.col("denied_schemas")))


def access_sample(objects: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """The first object of each schema in listing order. Every task keeps one row per schema before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*lead, *SCHEMA_KEYS).orderBy(*listing_order()))
    return objects.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def grants(denied: DataFrame, principal: str, lead: Sequence[str] = ()) -> DataFrame:
    """Statements that would give the missing access: one for each catalog, two for each denied schema.
    Ordered by catalog, schema (empty for the catalog's own) and `ord`."""
    to, catalog = quoted(F.lit(principal)), quoted("catalog_name")
    schema = F.concat(catalog, F.lit("."), quoted("schema_name"))

    def statement(ord_: int, privilege: str, kind: str, name: Column) -> Column:
        text = F.concat(F.lit(f"GRANT {privilege} ON {kind} "), name, F.lit(" TO "), to, F.lit(";"))
        return F.struct(F.lit(ord_).alias("ord"), text.alias("statement"))

    for_catalogs = (denied.select(*lead, "catalog_name").distinct()
                    .select(*lead, "catalog_name", F.lit("").alias("schema_name"),
                            statement(0, "USE CATALOG", "CATALOG", catalog).alias("s")))
    for_schemas = denied.select(*lead, *SCHEMA_KEYS).distinct().select(
        *lead, *SCHEMA_KEYS, F.explode(F.array(statement(1, "USE SCHEMA", "SCHEMA", schema),
                                               statement(2, "SELECT", "SCHEMA", schema))).alias("s"))
    return for_catalogs.unionByName(for_schemas).select(*lead, *SCHEMA_KEYS, "s.*")


def named_schemas(schemas: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """For each catalog the number of schemas and the first few names, with an ellipsis when there are more."""
    keys = [*lead, "catalog_name"]
    distinct = schemas.select(*lead, *SCHEMA_KEYS).distinct()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("schema_name"))
    first = (distinct.withColumn("_place", place).where(F.col("_place") <= NAMED_SCHEMAS)
             .groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list("schema_name")), ", ").alias("names")))
    counted = distinct.groupBy(*keys).agg(F.count("*").alias("schemas"))
    more = F.when(F.col("schemas") > NAMED_SCHEMAS, ", …").otherwise("")
    return counted.join(first, keys).withColumn("names", F.concat("names", more))
