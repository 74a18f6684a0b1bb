"""Scans and listings."""

from pyspark.sql import functions as F

from ddlscope.functions.ddl import kind_from_ddl, kind_from_table_type
from ddlscope.functions.text import kind_or_table, label, like_matches, listing_order, quoted
from ddlscope.operators import listing, outcomes, selection
from ddlscope.operators.positions import with_position
from ddlscope.plans import importing
from ddlscope.session import scratch_path
from ddlscope.sinks import harvest
from ddlscope.sources import snapshots
from workload.registry import Tables, query
from workload.sql import LISTED, RESOLVED, STREAMING, kind_of_ddl

PATTERN = "fact_* | *widget*"
_LIKE = "regexp_matches(object_name, '(?i)\\A(?:fact_.*|.*widget.*)\\z')"


def snapshot(t: Tables) -> importing.Snapshot:
    return importing.Snapshot(
        tables=t("fx_tables"), views=t("fx_views"), information=t("fx_info_tables"), properties=t("fx_describe"),
        schema_status=t("fx_schema_status"), ddl=t("fx_ddl").drop("kind"), selection=t("fx_selection"))


def all_objects(t: Tables, **options):
    return listing.list_objects(t("fx_tables"), t("fx_views"), snapshot(t).streaming(), **options)


@query("SELECT DISTINCT catalog_name FROM fx_describe")
def s1_catalogs(t):
    return snapshots.catalog_names(t("fx_describe"))


@query("SELECT DISTINCT catalog_name, schema_name FROM fx_objects "
       "WHERE regexp_matches(schema_name, '(?i)\\A(?:brand_1.*|brand_25)\\z')")
def s4_schemas(t):
    return snapshots.schema_names(t("fx_objects"), "BRAND_1*|brand_25")


@query("SELECT catalog_name, schema_name, object_name FROM fx_tables WHERE NOT is_temporary")
def s5_tables(t):
    return snapshots.tables(t("fx_tables"))


@query("""SELECT catalog_name, schema_name, object_name, CASE WHEN is_materialized THEN 'MATERIALIZED VIEW' ELSE 'VIEW' END
          AS kind FROM fx_views WHERE NOT is_temporary""")
def s6_views(t):
    return snapshots.views(t("fx_views"))


@query(f"WITH {STREAMING} SELECT * FROM streaming")
def s7_streaming_names(t):
    return snapshot(t).streaming().distinct()


@query("""SELECT catalog_name, schema_name, object_name, replace(CASE WHEN table_type IN ('VIEW', 'MATERIALIZED_VIEW')
            THEN table_type ELSE 'TABLE' END, '_', ' ') AS kind
          FROM fx_objects WHERE table_type <> 'STREAMING_TABLE' AND NOT is_temporary""")
def s8_typed_listing(t):
    return snapshots.typed_listing(t("fx_objects"))


@query("""SELECT catalog_name, schema_name, 'STREAMING TABLE' AS kind, count(*) AS excluded
          FROM fx_objects WHERE table_type = 'STREAMING_TABLE' GROUP BY ALL""")
def s8_typed_excluded(t):
    return listing.excluded_counts(snapshots.typed_listing_excluded(t("fx_objects")))


@query("SELECT catalog_name, schema_name, object_name, ddl FROM fx_ddl")
def s9_ddl(t):
    return snapshots.ddl_texts(t("fx_ddl"))


@query(f"WITH {LISTED} SELECT *, row_number() OVER (PARTITION BY catalog_name "
       "ORDER BY schema_name, lower(object_name), object_name) AS position FROM listed")
def l1_listing(t):
    return with_position(all_objects(t), listing_order(), ["catalog_name"])


@query(f"WITH {LISTED} SELECT * FROM listed WHERE {_LIKE}")
def l1_listing_filtered(t):
    return all_objects(t, pattern=PATTERN)


@query(f"SELECT catalog_name, schema_name, object_name FROM fx_objects WHERE {_LIKE}")
def f1_like(t):
    return t("fx_objects").where(like_matches("object_name", PATTERN)).select("catalog_name", "schema_name", "object_name")


_STARTS = "fact_b* | DIM_?olt* | stg.c*"
_STARTS_LIKE = "regexp_matches(object_name, '(?i)\\A(?:fact_b.*|dim_\\?olt.*|stg\\.c.*)\\z')"


# From a listing that is sorted by name, of which the reader takes what can match.
@query(f"SELECT catalog_name, schema_name, object_name FROM fx_tables WHERE NOT is_temporary AND {_STARTS_LIKE}")
def f1_like_by_name(t):
    path = scratch_path(t.spark, "named")
    snapshots.write_by_name(t("fx_tables"), path)
    return snapshots.tables(t.spark.read.parquet(path), _STARTS)


@query("SELECT catalog_name, schema_name, object_name FROM fx_objects WHERE NOT is_temporary")
def f2_permanent(t):
    return t("fx_objects").where(snapshots.permanent()).select("catalog_name", "schema_name", "object_name")


@query(f"WITH {LISTED} SELECT catalog_name, schema_name, object_name, kind FROM kinds WHERE contains(kind, 'VIEW')")
def f3_views_only(t):
    return all_objects(t, want_tables=False)


@query(f"WITH {LISTED} SELECT catalog_name, schema_name, object_name, kind FROM listed WHERE NOT contains(kind, 'VIEW')")
def f3_tables_only(t):
    return all_objects(t, want_views=False)


@query(f"WITH {RESOLVED} SELECT catalog_name, schema_name, object_name, kind FROM known WHERE kind <> 'STREAMING TABLE'")
def f4_supported(t):
    return outcomes.supported(outcomes.write_back(all_objects(t), t("fx_ddl"))).drop("ddl")


@query(f"WITH {LISTED} SELECT *, CAST(NULL AS STRING) AS ddl FROM listed")
def p1_object_records(t):
    return listing.object_records(all_objects(t))


@query(f"WITH {LISTED} SELECT catalog_name, schema_name, object_name, kind FROM kinds")
def j1_view_kinds(t):
    return listing.with_view_kinds(snapshots.tables(t("fx_tables")), snapshots.views(t("fx_views")))


# Of a view that was seen twice the last row counts.
@query("""WITH last AS (SELECT *, row_number() OVER (PARTITION BY catalog_name, schema_name, object_name ORDER BY seq DESC) AS nth
            FROM fx_view_log WHERE NOT is_temporary)
          SELECT t.catalog_name, t.schema_name, t.object_name, CASE WHEN l.object_name IS NULL THEN 'TABLE'
            WHEN l.is_materialized THEN 'MATERIALIZED VIEW' ELSE 'VIEW' END AS kind FROM fx_tables t LEFT JOIN last l
            ON l.nth = 1 AND l.catalog_name = t.catalog_name AND l.schema_name = t.schema_name AND l.object_name = t.object_name
          WHERE NOT t.is_temporary""")
def j1_view_kinds_by_arrival(t):
    return listing.with_view_kinds(snapshots.tables(t("fx_tables")), snapshots.views(t("fx_view_log")), arrival="seq")


@query(f"WITH {LISTED} SELECT catalog_name, schema_name, object_name FROM kinds WHERE NOT is_streaming")
def j2_without_streaming(t):
    return listing.without_streaming(snapshots.tables(t("fx_tables")), snapshot(t).streaming())


@query(f"WITH {RESOLVED} SELECT catalog_name, schema_name, object_name, kind, ddl FROM known")
def j8_write_back(t):
    return outcomes.write_back(all_objects(t), t("fx_ddl"))


_LAST = """
last AS (SELECT * FROM fx_ddl_log WHERE ddl IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY catalog_name, schema_name, object_name ORDER BY seq DESC) = 1)"""


@query(f"""WITH {LISTED}, {_LAST} SELECT l.catalog_name, l.schema_name, l.object_name, coalesce({kind_of_ddl("d.ddl")}, l.kind) AS kind,
             d.ddl FROM listed l LEFT JOIN last d USING (catalog_name, schema_name, object_name)""")
def j8_latest_ddl(t):
    return outcomes.write_back(all_objects(t), outcomes.latest_ddl(t("fx_ddl_log"), "seq"))


def _harvested(t, replace):
    """A store of two generations: the second has the texts of all objects, the first of a third of them."""
    store = harvest.Harvest(t.spark, scratch_path(t.spark, "harvest"), buckets=8)
    store.add(t("fx_ddl").where(F.length("object_name") % 3 == 0))
    store.add(t("fx_ddl").withColumn("ddl", F.concat("ddl", F.lit(" -- again"))), replace)
    return store


_GENERATIONS = """
harvested AS (SELECT catalog_name, schema_name, object_name, CASE WHEN length(object_name) % 3 = 0 {kept} THEN ddl ELSE ddl || ' -- again' END AS ddl,
  CAST(CASE WHEN length(object_name) % 3 = 0 {kept} THEN 1 ELSE 2 END AS BIGINT) AS generation FROM fx_ddl WHERE ddl IS NOT NULL)"""
_RESUMED = f"""SELECT l.catalog_name, l.schema_name, l.object_name, coalesce({kind_of_ddl("d.ddl")}, l.kind) AS kind, d.ddl, d.generation
               FROM listed l LEFT JOIN harvested d USING (catalog_name, schema_name, object_name)"""


@query(f"WITH {LISTED}, {_GENERATIONS.format(kept='')} {_RESUMED}")
def j8_harvest(t):
    return _harvested(t, False).write_back(all_objects(t))


@query(f"WITH {LISTED}, {_GENERATIONS.format(kept='AND false')} {_RESUMED}")
def j8_harvest_replaced(t):
    return _harvested(t, True).write_back(all_objects(t))


@query("""SELECT catalog_name, schema_name, object_name FROM fx_ddl d LEFT JOIN fx_selection s USING (catalog_name, schema_name, object_name)
          WHERE coalesce(s.selected, false) AND (d.ddl IS NULL OR length(object_name) % 3 <> 0)""")
def f7_incremental_harvest(t):
    store = harvest.Harvest(t.spark, scratch_path(t.spark, "harvest"), buckets=8)
    store.add(t("fx_ddl").where(F.length("object_name") % 3 == 0))
    objects = selection.with_selection(t("fx_ddl").drop("ddl"), t("fx_selection"))
    return store.remaining(objects).select("catalog_name", "schema_name", "object_name")


@query(f"WITH {RESOLVED} SELECT catalog_name, schema_name, object_name, kind FROM known WHERE kind <> 'STREAMING TABLE'")
def j9_without_dropped(t):
    known = outcomes.write_back(all_objects(t), t("fx_ddl")).drop("ddl")
    return outcomes.without(known, outcomes.unsupported(known))


@query(f"""WITH {RESOLVED} SELECT s.* FROM fx_selection s WHERE NOT EXISTS (SELECT 1 FROM known k
           WHERE k.kind = 'STREAMING TABLE' AND k.catalog_name = s.catalog_name AND k.schema_name = s.schema_name
             AND k.object_name = s.object_name)""")
def j9_selection_without_dropped(t):
    known = outcomes.write_back(all_objects(t), t("fx_ddl"))
    return outcomes.without(t("fx_selection"), outcomes.unsupported(known))


@query(f"""WITH {LISTED} SELECT s.catalog_name, count(*) AS schemas, count(s.reason) AS failed_schemas,
             CAST(coalesce(sum(o.n), 0) AS BIGINT) AS objects
           FROM fx_schema_status s LEFT JOIN (SELECT catalog_name, schema_name, count(*) AS n FROM listed GROUP BY ALL) o
             ON s.reason IS NULL AND o.catalog_name = s.catalog_name AND o.schema_name = s.schema_name
           GROUP BY s.catalog_name""")
def a3_listing_summary(t):
    return listing.listing_summary(importing.list_objects(snapshot(t)), t("fx_schema_status"))


@query(f"""WITH {LISTED} SELECT catalog_name, schema_name, 'STREAMING TABLE' AS kind, count(*) AS excluded
           FROM kinds WHERE is_streaming GROUP BY ALL""")
def a4_excluded_by_listing(t):
    return listing.excluded_counts(listing.streaming_only(snapshots.tables(t("fx_tables")), snapshot(t).streaming()))


@query(f"""WITH {RESOLVED} SELECT catalog_name, schema_name, kind, count(*) AS excluded
           FROM known WHERE kind = 'STREAMING TABLE' GROUP BY ALL""")
def a4_excluded_by_ddl(t):
    return listing.excluded_counts(outcomes.unsupported(outcomes.write_back(all_objects(t), t("fx_ddl"))))


@query("""SELECT catalog_name, schema_name, substring(trim(split_part(split_part(reason, 'JVM stacktrace', 1), chr(10), 1)),
            1, 120) AS reason, greatest(count(*) OVER (PARTITION BY catalog_name) - 25, 0) AS more
          FROM fx_schema_status WHERE reason IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY catalog_name ORDER BY schema_name) <= 25""")
def a18_skipped_schemas(t):
    return listing.skipped_schemas(t("fx_schema_status"))


@query("""SELECT day, catalog_name, schema_name, split_part(reason, chr(10), 1) AS reason,
            greatest(count(*) OVER (PARTITION BY day, catalog_name) - 25, 0) AS more
          FROM fx_listing_runs WHERE reason IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY day, catalog_name ORDER BY schema_name) <= 25""")
def a18_skipped_schemas_by_day(t):
    return listing.skipped_schemas(t("fx_listing_runs"), lead=["day"])


@query(f"""WITH {LISTED}, kept AS (SELECT catalog_name, count(*) AS objects FROM listed l WHERE NOT EXISTS (
               SELECT 1 FROM fx_partial_status s WHERE s.reason IS NOT NULL AND s.catalog_name = l.catalog_name
                 AND s.schema_name = l.schema_name) GROUP BY ALL),
             asked AS (SELECT catalog_name, count(*) AS schemas, count(reason) AS failed_schemas FROM fx_partial_status GROUP BY ALL),
             named AS (SELECT catalog_name FROM kept UNION SELECT catalog_name FROM asked)
           SELECT n.catalog_name, coalesce(schemas, 0) AS schemas, coalesce(failed_schemas, 0) AS failed_schemas,
             coalesce(objects, 0) AS objects FROM named n LEFT JOIN kept USING (catalog_name) LEFT JOIN asked USING (catalog_name)""")
def a3_listing_summary_partial(t):
    listed = listing.listed_schemas_only(all_objects(t), t("fx_partial_status"))
    return listing.listing_summary(listed, t("fx_partial_status"))


@query("""SELECT catalog_name, schema_name, object_name, row_number() OVER (PARTITION BY catalog_name
            ORDER BY schema_name, lower(object_name), object_name) AS position FROM fx_tables""")
def o1_listing_order(t):
    return with_position(t("fx_tables").drop("is_temporary"), listing_order(), ["catalog_name"])


@query("SELECT catalog_name, row_number() OVER (ORDER BY catalog_name) AS position "
       "FROM (SELECT DISTINCT catalog_name FROM fx_describe)")
def o2_sorted_catalogs(t):
    return with_position(snapshots.catalog_names(t("fx_describe")), [F.col("catalog_name")])


@query("""SELECT catalog_name, schema_name, row_number() OVER (PARTITION BY catalog_name ORDER BY schema_name) AS position
          FROM (SELECT DISTINCT catalog_name, schema_name FROM fx_objects)""")
def o2_sorted_schemas(t):
    return with_position(snapshots.schema_names(t("fx_objects")), [F.col("schema_name")], ["catalog_name"])


@query(f"""WITH {LISTED} SELECT l.* FROM listed l JOIN fx_schema_status s USING (catalog_name, schema_name)
           WHERE s.reason IS NULL""")
def u1_listed_schemas(t):
    return importing.list_objects(snapshot(t))


@query(f"""WITH {LISTED} SELECT catalog_name, schema_name, object_name FROM fx_tables
           EXCEPT SELECT catalog_name, schema_name, object_name FROM kinds WHERE is_streaming""")
def u3_difference(t):
    dropped = listing.streaming_only(snapshots.tables(t("fx_tables")), snapshot(t).streaming())
    return outcomes.without(t("fx_tables").drop("is_temporary"), dropped)


@query("""SELECT catalog_name, schema_name, object_name, CASE table_type WHEN 'VIEW' THEN 'VIEW'
            WHEN 'STREAMING_TABLE' THEN 'STREAMING TABLE' WHEN 'MATERIALIZED_VIEW' THEN 'MATERIALIZED VIEW'
            ELSE 'TABLE' END AS kind FROM fx_objects""")
def c3_kind_from_type(t):
    kind = kind_from_table_type(F.lower("table_type")).alias("kind")
    return t("fx_objects").select("catalog_name", "schema_name", "object_name", kind)


@query(f"SELECT catalog_name, schema_name, object_name, {kind_of_ddl('ddl')} AS ddl_kind FROM fx_ddl")
def c4_kind_from_ddl(t):
    return t("fx_ddl").select("catalog_name", "schema_name", "object_name", kind_from_ddl("ddl").alias("ddl_kind"))


@query(f"SELECT {kind_of_ddl('ddl')} AS ddl_kind, count(*) AS objects FROM fx_bulk GROUP BY ALL")
def c4_kind_from_ddl_bulk(t):
    return t("fx_bulk").groupBy(kind_from_ddl("ddl").alias("ddl_kind")).agg(F.count("*").alias("objects"))


@query("""SELECT schema_name || '.' || object_name AS label, coalesce(nullif(kind, ''), 'TABLE') AS kind
          FROM (SELECT schema_name, object_name, CASE kind WHEN 'TABLE' THEN NULL WHEN 'VIEW' THEN '' ELSE kind END AS kind
                FROM fx_ddl)""")
def c7_label(t):
    unknown = F.when(F.col("kind") == "VIEW", "").when(F.col("kind") != "TABLE", F.col("kind"))
    return t("fx_ddl").select(label().alias("label"), kind_or_table(unknown).alias("kind"))


@query("SELECT c_custkey, '`' || replace(replace(c_name, '#', '`'), '`', '``') || '`' AS quoted FROM customer")
def c8_quoted(t):
    return t("customer").select("c_custkey", quoted(F.replace("c_name", F.lit("#"), F.lit("`"))).alias("quoted"))
