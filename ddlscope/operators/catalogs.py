"""Catalog metadata: foreign catalogs, connections, governed workspaces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ddlscope.fixed import UNGOVERNED_CATALOGS


def with_catalog_metadata(rows: DataFrame, properties: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """Add type and connection of each row's catalog; an unknown catalog has an empty type and no connection.
    The join carries no broadcast hint: Spark broadcasts the metadata when its measured size allows it, and else
    splits the partitions of a catalog that holds much of the rows."""
    return (rows.join(properties, [*lead, "catalog_name"], "left")
            .withColumn("catalog_type", F.coalesce("catalog_type", F.lit(""))))


def with_connection(catalogs: DataFrame, connections: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """Add the attributes of each catalog's connection, empty where it has none or it is not visible."""
    joined = catalogs.join(connections, [*lead, "connection_name"], "left")
    for column in ("connection_type", "host", "port"):
        joined = joined.withColumn(column, F.coalesce(column, F.lit("")))
    return joined


def is_foreign(catalog_type: str = "catalog_type") -> Column:
    return F.coalesce(F.col(catalog_type), F.lit("")).contains("FOREIGN")


def foreign_catalogs(properties: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    return properties.where(is_foreign()).select(*lead, "catalog_name")


def foreign_summary(catalogs: DataFrame, lead: Sequence[str] = ()) -> DataFrame:
    """Number of catalogs and of foreign ones; `catalogs` carries the catalog type."""
    return catalogs.groupBy(*lead).agg(F.count("*").alias("catalogs"), F.count_if(is_foreign()).alias("foreign_catalogs"))


def governed_workspaces(catalogs: DataFrame, workspace: Sequence[str] = ("workspace_id",)) -> DataFrame:
    """Whether a workspace has a governed metastore. `hive_metastore` itself is taken as a sign of one."""
    sign = F.col("catalog_name").isin("system", "hive_metastore") | ~F.col("catalog_name").isin(*UNGOVERNED_CATALOGS)
    return catalogs.groupBy(*workspace).agg(F.bool_or(sign).alias("governed"))
