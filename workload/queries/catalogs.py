"""Catalog metadata."""

from ddlscope.operators import catalogs
from ddlscope.sources import snapshots
from workload.registry import query
from workload.sql import DESCRIBED


def described(t):
    return snapshots.catalog_properties(t("fx_describe"))


@query(f"WITH {DESCRIBED} SELECT * FROM described")
def s2_catalog_properties(t):
    return described(t)


@query("SELECT connection_name, connection_type, host, coalesce(port, '') AS port FROM fx_connections")
def s3_connections(t):
    return snapshots.connections(t("fx_connections"))


@query(f"WITH {DESCRIBED} SELECT catalog_name FROM described WHERE contains(catalog_type, 'FOREIGN')")
def f8_foreign_catalogs(t):
    return catalogs.foreign_catalogs(described(t))


@query(f"""WITH {DESCRIBED} SELECT o.catalog_name, schema_name, object_name, coalesce(catalog_type, '') AS catalog_type,
             connection_name FROM fx_tables o LEFT JOIN described d ON d.catalog_name = o.catalog_name""")
def j4_catalog_metadata(t):
    return catalogs.with_catalog_metadata(t("fx_tables").drop("is_temporary"), described(t))


@query(f"""WITH {DESCRIBED} SELECT d.catalog_name, d.catalog_type, d.connection_name,
             coalesce(connection_type, '') AS connection_type, coalesce(host, '') AS host, coalesce(port, '') AS port
           FROM described d LEFT JOIN fx_connections c ON c.connection_name = d.connection_name""")
def j5_connections(t):
    return catalogs.with_connection(described(t), snapshots.connections(t("fx_connections")))


@query(f"""WITH {DESCRIBED} SELECT count(*) AS catalogs, count(*) FILTER (contains(catalog_type, 'FOREIGN'))
             AS foreign_catalogs FROM described""")
def a14_foreign_summary(t):
    return catalogs.foreign_summary(described(t))


@query("""SELECT workspace_id, bool_or(catalog_name IN ('system', 'hive_metastore')
            OR catalog_name NOT IN ('spark_catalog', 'samples', 'hive_metastore')) AS governed
          FROM fx_workspace_catalogs GROUP BY workspace_id""")
def a15_governed_workspaces(t):
    return catalogs.governed_workspaces(t("fx_workspace_catalogs"))
