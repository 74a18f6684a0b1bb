"""Snapshots of several days through one job each: every key is led by the day."""

from pyspark.sql import functions as F

from ddlscope.functions.text import listing_order
from ddlscope.operators import failures, listing, outcomes, selection
from ddlscope.operators.positions import with_position
from workload.queries.errors import GROUPS
from workload.registry import Tables, query
from workload.sql import FAILED, kind_of_ddl

DAY = ["day"]
_LISTED = """
streaming AS (SELECT DISTINCT day, catalog_name, schema_name, lower(object_name) AS lower_name FROM fx_daily_objects
  WHERE table_type = 'STREAMING_TABLE' AND catalog_name <> 'hive_metastore'),
listed AS (
  SELECT o.day, o.catalog_name, o.schema_name, o.object_name, CASE o.table_type WHEN 'VIEW' THEN 'VIEW'
    WHEN 'MATERIALIZED_VIEW' THEN 'MATERIALIZED VIEW' ELSE 'TABLE' END AS kind
  FROM fx_daily_objects o LEFT JOIN streaming s ON s.day = o.day AND s.catalog_name = o.catalog_name
    AND s.schema_name = o.schema_name AND s.lower_name = lower(o.object_name)
  WHERE NOT o.is_temporary AND s.day IS NULL)"""
_FAILED = FAILED.replace("fx_attempts", "fx_daily_attempts")
_DENIED = _FAILED + """,
denied AS (SELECT DISTINCT day, catalog_name, schema_name FROM failed WHERE permission)"""
_KNOWN = _LISTED + f""",
known AS (SELECT l.day, l.catalog_name, l.schema_name, l.object_name, coalesce({kind_of_ddl('d.ddl')}, l.kind) AS kind, d.ddl
  FROM listed l LEFT JOIN fx_daily_ddl d USING (day, catalog_name, schema_name, object_name)),
chosen AS (SELECT k.*, coalesce(s.selected, false) AS selected FROM known k
  LEFT JOIN fx_daily_selection s USING (day, catalog_name, schema_name, object_name))"""


def objects(t: Tables):
    seen = t("fx_daily_objects")
    is_streaming = (F.col("table_type") == "STREAMING_TABLE") & (F.col("catalog_name") != "hive_metastore")
    streaming = seen.where(is_streaming).select(*DAY, "catalog_name", "schema_name", F.lower("object_name").alias("lower_name")).distinct()
    views = seen.where(F.col("table_type").isin("VIEW", "MATERIALIZED_VIEW"))
    views = views.withColumn("is_materialized", F.col("table_type") == "MATERIALIZED_VIEW").drop("table_type")
    return listing.list_objects(seen.drop("table_type"), views, streaming, lead=DAY)


def chosen(t: Tables):
    known = outcomes.write_back(objects(t), t("fx_daily_ddl"), lead=DAY)
    return selection.with_selection(known, t("fx_daily_selection"), lead=DAY)


def failed(t: Tables):
    return failures.failures(t("fx_daily_attempts"))


def denied(t: Tables):
    return failures.denied_schemas(failed(t), lead=DAY)


@query(f"""WITH {_LISTED} SELECT *, row_number() OVER (PARTITION BY day, catalog_name
             ORDER BY schema_name, lower(object_name), object_name) AS position FROM listed""")
def l1_listing_by_day(t):
    return with_position(objects(t), listing_order(), [*DAY, "catalog_name"])


@query(f"WITH {_KNOWN} SELECT * FROM chosen")
def j8_write_back_by_day(t):
    return chosen(t)


@query(f"""WITH {_KNOWN} SELECT day, catalog_name, schema_name, count(*) FILTER (selected) AS selected, count(*) AS total
           FROM chosen GROUP BY ALL""")
def a2_schema_counts_by_day(t):
    return selection.schema_counts(chosen(t), lead=DAY)


@query(f"""WITH {_LISTED}, kept AS (SELECT l.day, l.catalog_name, count(*) AS objects FROM listed l
             JOIN fx_daily_status s USING (day, catalog_name, schema_name) WHERE s.reason IS NULL GROUP BY ALL),
             asked AS (SELECT day, catalog_name, count(*) AS schemas, count(reason) AS failed_schemas FROM fx_daily_status GROUP BY ALL)
           SELECT day, catalog_name, schemas, failed_schemas, coalesce(objects, 0) AS objects FROM asked LEFT JOIN kept USING (day, catalog_name)""")
def a3_listing_summary_by_day(t):
    status = t("fx_daily_status")
    return listing.listing_summary(listing.listed_schemas_only(objects(t), status, lead=DAY), status, lead=DAY)


@query(f"""WITH {_LISTED} SELECT day, catalog_name, schema_name, object_name, kind FROM (SELECT *, row_number() OVER (
             PARTITION BY day, catalog_name, schema_name ORDER BY lower(object_name), object_name) AS nth FROM listed) WHERE nth = 1""")
def a5_access_sample_by_day(t):
    return failures.access_sample(objects(t), lead=DAY)


@query(f"WITH {_FAILED}, {GROUPS.format(within='day,', partition='PARTITION BY day')}")
def a6_failure_groups_by_day(t):
    return failures.failure_groups(failed(t), ["ts", "attempt_id"], DAY)


@query(f"""WITH {_FAILED} SELECT day, permission, count(*) AS failures, count(DISTINCT reason) AS reasons,
             count(DISTINCT (catalog_name, schema_name)) AS schemas FROM failed GROUP BY ALL""")
def a7_failure_split_by_day(t):
    return failures.failure_split(failed(t), lead=DAY)


@query(f"""WITH {_DENIED}, flagged AS (SELECT o.day, o.catalog_name, o.schema_name, d.schema_name IS NOT NULL AS is_denied
             FROM (SELECT DISTINCT day, catalog_name, schema_name FROM fx_daily_objects) o
             LEFT JOIN denied d ON d.day = o.day AND d.catalog_name = o.catalog_name AND d.schema_name = o.schema_name)
           SELECT day, catalog_name, count(*) AS schemas, count(*) FILTER (is_denied) AS denied_schemas,
             bool_and(is_denied) AS all_denied FROM flagged GROUP BY ALL""")
def a8_fully_denied_by_day(t):
    return failures.fully_denied_catalogs(t("fx_daily_objects"), denied(t), lead=DAY)


@query(f"""WITH {_LISTED}, {_DENIED} SELECT l.* FROM listed l JOIN denied d USING (day, catalog_name, schema_name)""")
def j7_objects_in_denied_schemas_by_day(t):
    return failures.objects_in(objects(t), denied(t), lead=DAY)


@query(f"""WITH {_DENIED}, quoted AS (SELECT *, '`' || catalog_name || '`' AS c, '`' || schema_name || '`' AS s FROM denied)
           SELECT DISTINCT day, catalog_name, '' AS schema_name, 0 AS ord, 'GRANT USE CATALOG ON CATALOG ' || c || ' TO `team`;' AS statement FROM quoted
           UNION ALL SELECT day, catalog_name, schema_name, 1, 'GRANT USE SCHEMA ON SCHEMA ' || c || '.' || s || ' TO `team`;' FROM quoted
           UNION ALL SELECT day, catalog_name, schema_name, 2, 'GRANT SELECT ON SCHEMA ' || c || '.' || s || ' TO `team`;' FROM quoted""")
def g1_grants_by_day(t):
    return failures.grants(denied(t), "team", lead=DAY)


@query(f"""WITH {_DENIED}, numbered AS (SELECT *, row_number() OVER (PARTITION BY day, catalog_name ORDER BY schema_name) AS nth FROM denied)
           SELECT day, catalog_name, count(*) AS schemas, string_agg(schema_name, ', ' ORDER BY nth) FILTER (nth <= 5)
             || CASE WHEN count(*) > 5 THEN ', …' ELSE '' END AS names FROM numbered GROUP BY day, catalog_name""")
def o4_named_schemas_by_day(t):
    return failures.named_schemas(denied(t), lead=DAY)
