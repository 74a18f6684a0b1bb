"""Error texts, failures, and the access they show to be missing."""

from ddlscope.functions import errors
from ddlscope.operators import failures
from workload.queries.listing import all_objects, snapshot
from ddlscope.plans import importing
from workload.registry import query
from workload.sql import FAILED, LISTED, RESOLVED, first_line, kind_of_ddl, permission, short_error, transient

_ARRIVAL = ["ts", "attempt_id"]
GROUPS = """
numbered AS (SELECT *, row_number() OVER (PARTITION BY {within} reason ORDER BY ts, attempt_id) AS nth FROM failed),
counted AS (SELECT {within} reason, count(*) AS failures,
    string_agg(schema_name || '.' || object_name, ', ' ORDER BY nth) FILTER (nth <= 3) AS examples
  FROM numbered GROUP BY {within} reason),
placed AS (SELECT *, row_number() OVER ({partition} ORDER BY failures DESC, reason) AS place FROM counted)
SELECT {within} place, failures, substring(reason, 1, 600) AS reason, examples FROM placed WHERE place <= 8"""
_DENIED = FAILED + """,
denied AS (SELECT DISTINCT catalog_name, schema_name FROM failed WHERE permission)"""


def failed(t):
    return failures.failures(t("fx_attempts"))


def denied(t):
    return failures.denied_schemas(failed(t))


@query(f"SELECT message_id, {short_error('message')} AS message FROM fx_messages")
def c1_short_error(t):
    return t("fx_messages").select("message_id", errors.short_error("message").alias("message"))


@query(f"""SELECT message_id, error_type || ': ' || coalesce(nullif({first_line('message')}, ''), '(no message)') AS line
           FROM fx_messages""")
def c2_error_line(t):
    return t("fx_messages").select("message_id", errors.error_line("error_type", "message").alias("line"))


@query(f"""WITH marked AS (SELECT attempt_id, attempt, {transient()} AND attempt < 4 AS retried FROM fx_attempts)
           SELECT attempt_id, retried, NOT retried AS is_final, CASE WHEN retried THEN least(pow(2.0, attempt), 16.0) * 0.75 END AS delay_min,
             CASE WHEN retried THEN least(pow(2.0, attempt), 16.0) * 1.25 END AS delay_max FROM marked""")
def c10_retry_policy(t):
    return t("fx_attempts").select("attempt_id", errors.is_retried().alias("retried"), errors.is_final().alias("is_final"),
                                   errors.retry_delay("min").alias("delay_min"), errors.retry_delay("max").alias("delay_max"))


@query(f"SELECT attempt_id, reason FROM fx_attempts WHERE {transient()}")
def f11_transient(t):
    return t("fx_attempts").where(errors.is_transient()).select("attempt_id", "reason")


@query(f"SELECT attempt_id, reason FROM fx_attempts WHERE {permission()}")
def f12_permission(t):
    return t("fx_attempts").where(errors.is_permission_error()).select("attempt_id", "reason")


@query(f"WITH {LISTED}, {_DENIED} SELECT l.* FROM listed l JOIN denied d USING (catalog_name, schema_name)")
def j7_objects_in_denied_schemas(t):
    return failures.objects_in(all_objects(t), denied(t))


@query(f"""WITH {RESOLVED}, first AS (SELECT l.*, row_number() OVER (PARTITION BY catalog_name, schema_name
             ORDER BY lower(object_name), object_name) AS nth FROM listed l JOIN fx_schema_status s
             USING (catalog_name, schema_name) WHERE s.reason IS NULL)
           SELECT f.catalog_name, f.schema_name, f.object_name, coalesce({kind_of_ddl('d.ddl')}, f.kind) AS kind, d.ddl
           FROM first f LEFT JOIN fx_ddl d USING (catalog_name, schema_name, object_name) WHERE nth = 1""")
def a5_access_sample(t):
    return importing.sample_access(snapshot(t), importing.list_objects(snapshot(t)))


@query(f"""WITH {LISTED}, first AS (SELECT *, row_number() OVER (PARTITION BY catalog_name, schema_name
             ORDER BY lower(object_name), object_name) AS nth FROM listed),
             denied AS (SELECT f.catalog_name, f.schema_name FROM first f JOIN fx_sample_outcomes o USING (catalog_name, schema_name, object_name)
               WHERE nth = 1 AND contains(reason, 'PERMISSION_DENIED')),
             flagged AS (SELECT l.catalog_name, l.schema_name, count(*) AS n, max(CASE WHEN d.schema_name IS NULL THEN 0 ELSE 1 END) AS is_denied
               FROM listed l LEFT JOIN denied d ON d.catalog_name = l.catalog_name AND d.schema_name = l.schema_name GROUP BY ALL)
           SELECT catalog_name, count(*) AS schemas, CAST(sum(is_denied) AS BIGINT) AS denied_schemas, min(is_denied) = 1 AS all_denied,
             CAST(sum(n * is_denied) AS BIGINT) AS affected FROM flagged GROUP BY catalog_name""")
def a8_access_check(t):
    return importing.access_check(all_objects(t), t("fx_sample_outcomes"), "team").catalogs


@query("""SELECT catalog_name, schema_name, object_name FROM (
            SELECT *, row_number() OVER (PARTITION BY catalog_name, schema_name ORDER BY lower(object_name), object_name) AS nth
            FROM fx_tables) WHERE nth = 1""")
def w2_first_of_schema(t):
    return failures.access_sample(t("fx_tables").drop("is_temporary"))


@query(f"WITH {FAILED}, {GROUPS.format(within='', partition='')}")
def a6_failure_groups(t):
    return failures.failure_groups(failed(t), _ARRIVAL)


@query(f"WITH {FAILED}, {GROUPS.format(within='permission,', partition='PARTITION BY permission')}")
def a6_failure_groups_by_permission(t):
    return failures.failure_groups(failed(t), _ARRIVAL, ["permission"])


@query(f"WITH {FAILED}, {GROUPS.format(within='run_id,', partition='PARTITION BY run_id')}")
def a6_failure_groups_by_run(t):
    return failures.failure_groups(failed(t), _ARRIVAL, ["run_id"])


@query(f"""WITH {FAILED} SELECT permission, count(*) AS failures, count(DISTINCT reason) AS reasons,
             count(DISTINCT (catalog_name, schema_name)) AS schemas FROM failed GROUP BY permission""")
def a7_failure_split(t):
    return failures.failure_split(failed(t))


@query(f"WITH {_DENIED} SELECT * FROM denied")
def a7_denied_schemas(t):
    return denied(t)


@query(f"""WITH {_DENIED}, flagged AS (SELECT o.catalog_name, o.schema_name, d.schema_name IS NOT NULL AS is_denied
             FROM (SELECT DISTINCT catalog_name, schema_name FROM fx_objects) o
             LEFT JOIN denied d ON d.catalog_name = o.catalog_name AND d.schema_name = o.schema_name)
           SELECT catalog_name, count(*) AS schemas, count(*) FILTER (is_denied) AS denied_schemas,
             bool_and(is_denied) AS all_denied FROM flagged GROUP BY catalog_name""")
def a8_fully_denied(t):
    return failures.fully_denied_catalogs(t("fx_objects"), denied(t))


@query(f"""WITH {_DENIED}, quoted AS (SELECT *, '`' || replace(catalog_name, '`', '``') || '`' AS c,
             '`' || replace(schema_name, '`', '``') || '`' AS s FROM denied)
           SELECT DISTINCT catalog_name, '' AS schema_name, 0 AS ord, 'GRANT USE CATALOG ON CATALOG ' || c || ' TO `data``team`;'
             AS statement FROM quoted
           UNION ALL SELECT catalog_name, schema_name, 1, 'GRANT USE SCHEMA ON SCHEMA ' || c || '.' || s || ' TO `data``team`;'
             FROM quoted
           UNION ALL SELECT catalog_name, schema_name, 2, 'GRANT SELECT ON SCHEMA ' || c || '.' || s || ' TO `data``team`;'
             FROM quoted""")
def g1_grants(t):
    return failures.grants(denied(t), "data`team")


@query(f"""WITH {_DENIED}, numbered AS (SELECT *, row_number() OVER (PARTITION BY catalog_name ORDER BY schema_name) AS nth
             FROM denied)
           SELECT catalog_name, count(*) AS schemas, string_agg(schema_name, ', ' ORDER BY nth) FILTER (nth <= 5)
             || CASE WHEN count(*) > 5 THEN ', …' ELSE '' END AS names FROM numbered GROUP BY catalog_name""")
def o4_named_schemas(t):
    return failures.named_schemas(denied(t))
