"""Pieces of the checking SQL that several queries share."""

from ddlscope.fixed import PERMISSION_MARKERS, TRANSIENT_MARKERS
from ddlscope.functions.text import LINE_ENDS, WHITESPACE

KEYS = "catalog_name, schema_name, object_name"

# Type and connection of each catalog, and the names of streaming tables, as CTEs.
DESCRIBED = """
described AS (
  SELECT catalog_name, coalesce(max(CASE WHEN lower(trim(k)) = 'catalog type' THEN upper(trim(v)) END), '') AS catalog_type,
    nullif(max(CASE WHEN lower(trim(k)) = 'connection name' THEN trim(v) END), '') AS connection_name
  FROM fx_describe GROUP BY catalog_name)"""
STREAMING = DESCRIBED + """,
streaming AS (
  SELECT DISTINCT catalog_name, table_schema AS schema_name, lower(table_name) AS lower_name FROM fx_info_tables
  WHERE table_type = 'STREAMING_TABLE' AND lower(catalog_name) NOT IN ('hive_metastore', 'spark_catalog')
    AND catalog_name NOT IN (SELECT catalog_name FROM described WHERE contains(catalog_type, 'FOREIGN')))"""
# All permanent objects with kind and with whether they are streaming tables, then the listing itself.
LISTED = STREAMING + """,
kinds AS (
  SELECT t.catalog_name, t.schema_name, t.object_name, coalesce(v.kind, 'TABLE') AS kind,
    EXISTS (SELECT 1 FROM streaming s WHERE s.catalog_name = t.catalog_name AND s.schema_name = t.schema_name
            AND s.lower_name = lower(t.object_name)) AS is_streaming
  FROM fx_tables t LEFT JOIN (
    SELECT catalog_name, schema_name, object_name,
      CASE WHEN is_materialized THEN 'MATERIALIZED VIEW' ELSE 'VIEW' END AS kind FROM fx_views WHERE NOT is_temporary) v
    USING (catalog_name, schema_name, object_name)
  WHERE NOT t.is_temporary),
listed AS (SELECT catalog_name, schema_name, object_name, kind FROM kinds WHERE NOT is_streaming)"""


def kind_of_ddl(ddl: str) -> str:
    head = f"upper(array_to_string(list_slice(string_split_regex(trim({ddl}), '\\s+'), 1, 6), ' '))"
    return (f"CASE WHEN contains({head}, 'MATERIALIZED VIEW') THEN 'MATERIALIZED VIEW' "
            f"WHEN contains({head}, 'STREAMING TABLE') THEN 'STREAMING TABLE' WHEN contains({head}, 'VIEW') THEN 'VIEW' "
            f"WHEN contains({head}, 'TABLE') THEN 'TABLE' END")


# Listing joined to the DDL, without unsupported kinds, then with the selection.
RESOLVED = LISTED + f""",
known AS (
  SELECT l.catalog_name, l.schema_name, l.object_name, coalesce({kind_of_ddl("d.ddl")}, l.kind) AS kind, d.ddl
  FROM listed l LEFT JOIN fx_ddl d USING (catalog_name, schema_name, object_name)),
resolved AS (
  SELECT k.*, coalesce(s.selected, false) AS selected FROM known k LEFT JOIN fx_selection s
    USING (catalog_name, schema_name, object_name) WHERE k.kind <> 'STREAMING TABLE')"""
# Objects with kind, DDL and selection straight from the fixtures, where the listing is not the point.
SELECTED = """
selected_objects AS (
  SELECT d.catalog_name, d.schema_name, d.object_name, d.kind, d.ddl, coalesce(s.selected, false) AS selected
  FROM fx_ddl d LEFT JOIN fx_selection s USING (catalog_name, schema_name, object_name))"""

# What an identifier and a quoted literal look like.
_IDENT = "(?:`(?:[^`]|``)+`|[A-Za-z_][\\w$]*)"
_LITERAL = "''(?:[^''\\\\]|\\\\.)*''|\"(?:[^\"\\\\]|\\\\.)*\""


def discard(ddl: str, catalog: str) -> str:
    """Catalog taken off three-part names; RE2 has no look-around, so what stands around the prefix is put back."""
    names = (f"'`' || regexp_escape(replace({catalog}, '`', '``')) || '`' || CASE WHEN regexp_full_match({catalog}, "
             f"'[A-Za-z_][\\w$]*') THEN '|' || regexp_escape({catalog}) ELSE '' END || CASE WHEN lower({catalog}) IN "
             "('hive_metastore', 'spark_catalog') THEN '|`hive_metastore`|hive_metastore|`spark_catalog`|spark_catalog' "
             "ELSE '' END")
    return (f"regexp_replace({ddl}, '(?i)({_LITERAL})|(^|[^\\w`.$])(?:' || {names} || "
            f"')\\s*\\.\\s*({_IDENT}\\s*\\.\\s*{_IDENT})', '\\1\\2\\3', 'g')")


def chunk(keep: bool = False, catalog: str = "catalog_name") -> str:
    if keep:
        return ("'-- ' || catalog_name || '.' || schema_name || '.' || object_name || chr(10) || ddl || ';' || chr(10)")
    return (f"'-- ' || schema_name || '.' || object_name || chr(10) || {discard('ddl', catalog)} || ';' || chr(10)")


def json_bytes(text: str) -> str:
    """Length of the text in ASCII-escaped JSON: one for each character, more for those that are escaped."""
    def count(others: str) -> str:
        return f"length(regexp_replace({text}, '{others}', '', 'g'))"
    return (f"(length({text}) + {count('[^\"\\\\\\n\\r\\t\\x08\\x0c]')} "
            f"+ 5 * {count('[\\x20-\\x7e\\n\\r\\t\\x08\\x0c]')} + 6 * {count('[\\x{0}-\\x{ffff}]')})")


def has_any(reason: str, markers: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(coalesce({reason}, ''), '{m}')" for m in markers) + ")"


def permission(reason: str = "reason") -> str:
    return has_any(reason, PERMISSION_MARKERS)


def transient(reason: str = "reason") -> str:
    return f"({has_any(reason, TRANSIENT_MARKERS)} AND NOT {permission(reason)})"


def trimmed(text: str) -> str:
    return f"trim({text}, '{WHITESPACE}')"


def short_error(message: str) -> str:
    return trimmed(f"split_part({message}, 'JVM stacktrace', 1)")


def first_line(message: str) -> str:
    return trimmed(f"regexp_extract({short_error(message)}, '^[^{LINE_ENDS}]*')")


OUTCOME = """CASE WHEN reason IS NULL AND kind = 'STREAMING TABLE' THEN 'excluded' WHEN reason IS NULL THEN 'generated'
  WHEN reason = 'cancelled' THEN 'cancelled' ELSE 'failed' END"""

# Failures, with whether permission is what is missing.
FAILED = f"""
failed AS (SELECT *, {permission()} AS permission FROM fx_attempts WHERE reason IS NOT NULL AND reason <> 'cancelled')"""
