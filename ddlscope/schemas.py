"""Schemas of the snapshot tables. Every input is read with one of these; nothing is inferred.
Schema texts, as `spark.read.schema` takes them."""

KEYS = ("catalog_name", "schema_name", "object_name")
SCHEMA_KEYS = ("catalog_name", "schema_name")

CATALOGS = "catalog_name string"
CATALOG_PROPERTIES = "catalog_name string, k string, v string"
CONNECTIONS = "connection_name string, connection_type string, host string, port string"
SCHEMAS = "catalog_name string, schema_name string"
TABLES = "catalog_name string, schema_name string, object_name string, is_temporary boolean"
VIEWS = (
    "catalog_name string, schema_name string, object_name string, is_temporary boolean, is_materialized boolean")
INFORMATION_TABLES = "catalog_name string, table_schema string, table_name string, table_type string"
TYPED_LISTING = (
    "catalog_name string, schema_name string, object_name string, table_type string, is_temporary boolean")
OBJECTS = "catalog_name string, schema_name string, object_name string, kind string, ddl string"
DDL = "catalog_name string, schema_name string, object_name string, ddl string"
SELECTION = "catalog_name string, schema_name string, object_name string, selected boolean"
OUTCOMES = (
    "attempt_id bigint, ts timestamp, run_id bigint, attempt int, catalog_name string, schema_name string, "
    "object_name string, kind string, reason string")
SCHEMA_STATUS = "catalog_name string, schema_name string, reason string"
PROJECTS = "project_id bigint, name string"
BRANCHES = "project_id bigint, branch_id bigint, branch_name string, is_main boolean"
REVISIONS = "project_id bigint, revision_id bigint, rev_number string, rev_name string"
RESPONSES = "project_id bigint, body string"
