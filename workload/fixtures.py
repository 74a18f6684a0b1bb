"""Tables of the shape the operators work on, derived from the given tables.

Each is one SQL text that both engines run. A text may use the given tables and other fixtures by name."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

FIXTURES = {
    # Listed objects, three catalogs and all table types.
    "fx_objects": """
        SELECT CASE p_partkey % 4 WHEN 1 THEN 'hive_metastore' WHEN 2 THEN 'ext-sales' ELSE 'main' END AS catalog_name,
          lower(replace(p_brand, '#', '_')) AS schema_name,
          CASE p_partkey % 3 WHEN 0 THEN 'fact_' WHEN 1 THEN 'Dim_' ELSE 'stg.' END
            || replace(p_name, ' ', '_') || '_' || CAST(p_partkey AS STRING) AS object_name,
          CASE p_type WHEN 'PROMO' THEN 'VIEW' WHEN 'ECONOMY' THEN 'MATERIALIZED_VIEW' WHEN 'SMALL' THEN 'STREAMING_TABLE'
            WHEN 'LARGE' THEN 'EXTERNAL' ELSE 'MANAGED' END AS table_type,
          p_size % 25 = 0 AS is_temporary FROM part""",
    "fx_tables": "SELECT catalog_name, schema_name, object_name, is_temporary FROM fx_objects",
    "fx_views": """
        SELECT catalog_name, schema_name, object_name, is_temporary, table_type = 'MATERIALIZED_VIEW' AS is_materialized
        FROM fx_objects WHERE table_type IN ('VIEW', 'MATERIALIZED_VIEW')""",
    # Names in upper case, so that the match has to ignore case.
    "fx_info_tables": """
        SELECT catalog_name, schema_name AS table_schema, upper(object_name) AS table_name, table_type FROM fx_objects""",
    # Statement texts, some not generated; each holds a literal, a name with spaces and a name in another catalog.
    "fx_ddl": """
        SELECT catalog_name, schema_name, object_name,
          CASE table_type WHEN 'VIEW' THEN 'VIEW' WHEN 'MATERIALIZED_VIEW' THEN 'MATERIALIZED VIEW'
            WHEN 'STREAMING_TABLE' THEN 'STREAMING TABLE' ELSE 'TABLE' END AS kind,
          CASE WHEN table_type = 'MANAGED' AND length(object_name) % 5 = 0 THEN NULL ELSE
            'CREATE ' || CASE table_type WHEN 'VIEW' THEN 'VIEW' WHEN 'MATERIALIZED_VIEW' THEN 'MATERIALIZED VIEW'
              WHEN 'STREAMING_TABLE' THEN 'OR REFRESH STREAMING TABLE' ELSE 'TABLE' END
            || ' `' || catalog_name || '`.`' || schema_name || '`.`' || object_name || '` COMMENT ' || chr(39) || 'from '
            || catalog_name || '.' || schema_name || '.src ' || chr(39) || ' AS SELECT * FROM `' || catalog_name || '` . `'
            || schema_name || '`.t JOIN other.' || schema_name || '.u' END AS ddl FROM fx_objects""",
    # A log of generated texts, up to three for an object, some of them null; and one of views seen, some first as plain ones.
    "fx_ddl_log": " UNION ALL ".join(f"""
        SELECT CAST({seq} AS BIGINT) AS seq, catalog_name, schema_name, object_name,
          CASE WHEN (length(object_name) + {seq}) % 4 = 0 THEN NULL ELSE ddl || ' -- {seq}' END AS ddl FROM fx_ddl""" for seq in (1, 2, 3)),
    "fx_view_log": """
        SELECT CAST(1 AS BIGINT) AS seq, catalog_name, schema_name, object_name, is_temporary, NOT is_materialized AS is_materialized FROM fx_views
        UNION ALL SELECT CAST(2 AS BIGINT), catalog_name, schema_name, object_name, is_temporary, is_materialized FROM fx_views
        WHERE length(object_name) % 2 = 0""",
    # Snapshots of three days: objects come and go, and some views become materialized.
    "fx_daily_objects": " UNION ALL ".join(f"""
        SELECT {day} AS day, catalog_name, schema_name, object_name, is_temporary,
          CASE WHEN table_type = 'VIEW' AND (length(object_name) + {day}) % 3 = 0 THEN 'MATERIALIZED_VIEW' ELSE table_type END AS table_type
        FROM fx_objects WHERE (length(object_name) + {day}) % 5 <> 0""" for day in (1, 2, 3)),
    "fx_daily_ddl": " UNION ALL ".join(f"""
        SELECT {day} AS day, catalog_name, schema_name, object_name, CASE WHEN length(object_name) % 4 <> {day} THEN ddl || ' -- {day}' END AS ddl
        FROM fx_ddl""" for day in (1, 2, 3)),
    "fx_daily_selection": " UNION ALL ".join(f"""
        SELECT {day} AS day, catalog_name, schema_name, object_name, (length(object_name) + {day}) % 2 = 0 AS selected
        FROM fx_selection""" for day in (1, 2, 3)),
    "fx_daily_status": """
        SELECT DISTINCT day, catalog_name, schema_name,
          CASE WHEN (length(schema_name) + day) % 4 = 0 THEN 'TimeoutException: ' || schema_name END AS reason FROM fx_daily_objects""",
    "fx_daily_attempts": "SELECT *, CAST(run_id % 3 AS INT) + 1 AS day FROM fx_attempts",
    # Many short texts; object names repeat.
    "fx_bulk": """
        SELECT 'main' AS catalog_name, 's' || CAST(l_suppkey AS STRING) AS schema_name,
          CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) AS object_name, l_returnflag,
          'CREATE VIEW main.s' || CAST(l_suppkey AS STRING) || '.v AS SELECT * FROM main.s' || CAST(l_suppkey AS STRING)
            || '.p' || CAST(l_partkey AS STRING) AS ddl FROM lineitem""",
    # External tables have no choice recorded; missing means not selected.
    "fx_selection": """
        SELECT catalog_name, schema_name, object_name, length(object_name) % 2 = 0 AS selected
        FROM fx_objects WHERE table_type <> 'EXTERNAL'""",
    "fx_attempts": """
        SELECT event_id AS attempt_id, ts, user_id AS run_id, CAST(event_id % 5 AS INT) AS attempt,
          CASE user_id % 4 WHEN 1 THEN 'hive_metastore' WHEN 2 THEN 'ext-sales' ELSE 'main' END AS catalog_name,
          'brand_' || CAST(user_id % 25 + 1 AS STRING) AS schema_name, 'obj_' || CAST(event_id % 997 AS STRING) AS object_name,
          CASE WHEN event_type = 'click' AND value < 10 THEN 'STREAMING TABLE' ELSE 'TABLE' END AS kind,
          CASE WHEN event_type IN ('click', 'view') THEN NULL
            WHEN event_type = 'error' AND value < 20 THEN
              'SparkException: [PERMISSION_DENIED] User does not have USE SCHEMA on Schema brand_'
              || CAST(user_id % 25 + 1 AS STRING)
            WHEN event_type = 'error' THEN 'SparkConnectGrpcException: REQUEST_LIMIT_EXCEEDED'
            WHEN event_type = 'signup' THEN 'AnalysisException: [TABLE_OR_VIEW_NOT_FOUND] t_' || CAST(user_id % 7 AS STRING)
            WHEN value < 5 THEN 'cancelled'
            ELSE 'IOException: HTTP 503 from metastore' END AS reason FROM events""",
    # Work of each run: what was tried, and the failed ones once more.
    # Some runs have no total yet.
    "fx_work": """
        SELECT run_id, count(*) + count(reason) AS total FROM fx_attempts GROUP BY run_id
        HAVING count(*) % 5 <> 0""",
    # Key/value rows of catalogs, keys padded and values empty at times; hive_metastore has none.
    "fx_describe": """
        SELECT 'cat_' || CAST(c_custkey AS STRING) AS catalog_name, 'Catalog Type' AS k,
          CASE WHEN c_nationkey % 2 = 0 THEN 'Foreign' ELSE 'Managed' END AS v FROM customer
        UNION ALL SELECT 'cat_' || CAST(c_custkey AS STRING), ' Connection Name ',
          CASE WHEN c_nationkey = 0 THEN '' ELSE 'conn_' || CAST(c_nationkey AS STRING) END FROM customer
        UNION ALL SELECT 'cat_' || CAST(c_custkey AS STRING), 'Owner', c_name FROM customer
        UNION ALL SELECT DISTINCT catalog_name, 'catalog type',
          CASE catalog_name WHEN 'ext-sales' THEN ' foreign_catalog ' ELSE 'MANAGED_CATALOG' END
        FROM fx_objects WHERE catalog_name <> 'hive_metastore'""",
    # Connections are named by supplier, so some that catalogs name are not visible.
    "fx_connections": """
        SELECT 'conn_' || CAST(s_suppkey AS STRING) AS connection_name,
          CASE WHEN s_nationkey % 3 = 0 THEN 'SQL_SERVER' ELSE 'POSTGRESQL' END AS connection_type,
          'db' || CAST(s_suppkey AS STRING) || '.example' AS host,
          CASE WHEN s_nationkey % 3 = 0 THEN '1434' WHEN s_nationkey % 3 = 1 THEN '5432' ELSE NULL END AS port FROM supplier""",
    # A project for each order; names repeat in other case and with other padding.
    "fx_projects": """
        SELECT o_orderkey AS project_id, CASE WHEN o_orderkey % 2 = 0
            THEN ' ' || o_orderpriority || ' ' || CAST(o_custkey AS STRING) || chr(9)
          ELSE lower(o_orderpriority) || ' ' || CAST(o_custkey AS STRING) END AS name FROM orders""",
    # A branch for each order and part: projects have none, one or more. A null flag is a missing one.
    "fx_branches": """
        SELECT project_id, branch_id, 'Branch ' || substring('ANR', flag, 1) || CAST(line AS STRING) AS branch_name,
          CASE flag WHEN 1 THEN true WHEN 2 THEN false ELSE NULL END AS is_main
        FROM (SELECT l_orderkey AS project_id, l_partkey AS branch_id, max(l_linenumber) AS line,
                max(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END) AS flag
              FROM lineitem GROUP BY l_orderkey, l_partkey) lines""",
    "fx_revisions": """
        SELECT o_custkey AS project_id, o_orderkey AS revision_id,
          CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderkey % 97 AS INT) END AS rev_number,
          CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS rev_name FROM orders""",
    # Proposed names: taken in other case, blank, and new.
    "fx_proposals": """
        SELECT project_id AS proposal_id, project_id, CASE WHEN project_id % 3 = 0 THEN upper(name) || ' '
          WHEN project_id % 3 = 1 THEN '  ' ELSE name || ' new' END AS proposed_name FROM fx_projects""",
    "fx_branch_proposals": """
        SELECT l_orderkey * 10 + l_linenumber AS proposal_id, l_orderkey AS project_id,
          CASE WHEN l_linenumber % 3 = 0 THEN ' ' WHEN l_linenumber % 3 = 1
            THEN ' branch ' || lower(l_returnflag) || CAST(l_linenumber AS STRING) || ' '
          ELSE 'Branch ' || l_returnflag || CAST(l_linenumber AS STRING) END AS proposed_name FROM lineitem""",
    # Submissions to new projects, projects and branches, on the last or on a given revision.
    "fx_requests": """
        SELECT o_orderkey AS request_id, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey END AS project_id,
          CASE o_orderkey % 4 WHEN 2 THEN o_custkey WHEN 1 THEN 0 END AS branch_id,
          CASE o_orderkey % 3 WHEN 0 THEN o_orderkey WHEN 1 THEN 0 END AS revision_id,
          'Model "' || CAST(o_custkey AS STRING) || '"' AS project_name, 'postgreSQL' AS db_type,
          'Branch ' || CAST(o_custkey AS STRING) AS branch_name, 'Import ' || o_orderpriority AS revision_name,
          o_orderstatus = 'F' AS strict, CASE o_orderstatus WHEN 'P' THEN 'All "objects"' WHEN 'O' THEN '' END AS diagram_name,
          'payloads/' || CAST(o_custkey AS STRING) AS payload_path FROM orders""",
    "fx_schema_status": """
        SELECT DISTINCT catalog_name, schema_name, CASE WHEN schema_name LIKE '%3' THEN
          'AnalysisException: [SCHEMA_NOT_FOUND] ' || schema_name || chr(10) || 'JVM stacktrace: x' ELSE NULL END AS reason
        FROM fx_objects""",
    # What became of each object when it was read as a sample.
    "fx_sample_outcomes": """
        SELECT catalog_name, schema_name, object_name, CASE
            WHEN catalog_name = 'ext-sales' OR length(object_name) % 3 = 0 THEN 'SparkException: [PERMISSION_DENIED] no USE SCHEMA'
            WHEN length(object_name) % 3 = 1 THEN 'IOException: HTTP 503' ELSE NULL END AS reason FROM fx_objects""",
    # A catalog without a status row, and catalogs without objects.
    "fx_partial_status": """
        SELECT * FROM fx_schema_status WHERE catalog_name <> 'hive_metastore'
        UNION ALL SELECT 'empty_' || n_name, 'none', CAST(NULL AS STRING) FROM nation""",
    # Listings of two catalogs on two days, in which many schemas fail.
    "fx_listing_runs": """
        SELECT c_custkey % 2 AS day, 'cat_' || CAST(c_nationkey % 2 AS STRING) AS catalog_name, c_name AS schema_name,
          CASE WHEN c_custkey % 8 <> 0 THEN 'TimeoutException: ' || c_name || chr(10) || c_mktsegment ELSE NULL END AS reason
        FROM customer""",
    "fx_workspace_catalogs": """
        SELECT s_nationkey AS workspace_id, CASE s_suppkey % 4 WHEN 0 THEN 'spark_catalog' WHEN 1 THEN 'samples'
          WHEN 2 THEN 'hive_metastore' ELSE 'cat_' || CAST(s_suppkey AS STRING) END AS catalog_name FROM supplier""",
    # Raw error messages, most with a stack trace; the text of documents stands for what users put in them.
    "fx_messages": """
        SELECT doc_id AS message_id, 'SparkException' AS error_type,
          CASE WHEN lang = 'en' THEN chr(10) || ' ' || chr(9) || text || chr(10) || 'JVM stacktrace:' || chr(10) || text
            WHEN n_chars % 3 = 0 THEN ' ' || chr(10) ELSE text END AS message FROM documents""",
}

_NAME = re.compile(r"\bfx_\w+")


def _needed(sql: str) -> list[str]:
    """Fixtures the text uses, each after those it uses itself."""
    found: list[str] = []
    for name in dict.fromkeys(_NAME.findall(sql)):
        found += [n for n in [*_needed(FIXTURES[name]), name] if n not in found]
    return found


def with_fixtures(sql: str) -> str:
    """The query with the fixtures it uses in front."""
    parts = [f"{name} AS ({FIXTURES[name].strip()})" for name in _needed(sql)]
    if not parts:
        return sql
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body


@lru_cache(maxsize=256)
def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table. Its files are listed and their schema read once per session; rows are read by each query."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fixture(spark: SparkSession, folder: str, name: str, **instead: DataFrame) -> DataFrame:
    """The fixture as one lazy plan over the given tables, or over the frames passed `instead` of them."""
    texts = {n: FIXTURES[n].strip() for n in _needed(name)}
    used = [t for t in GIVEN if any(re.search(rf"\bFROM {t}\b", text) for text in texts.values())]
    parts = [f"{t} AS (SELECT * FROM {{{t}}})" for t in used] + [f"{n} AS ({text})" for n, text in texts.items()]
    frames = {t: instead.get(t, given(spark, folder, t)) for t in used}
    return spark.sql("WITH " + ",\n".join(parts) + f"\nSELECT * FROM {name}", **frames)
