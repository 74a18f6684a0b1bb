"""Scans of stored JSON responses, one response per row in `body`, parsed with declared schemas.

Ids come as text, as they stand, since they are only put into paths; `position` is the place in the response's list, from 0,
which decides where the first of several counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_PROJECT = "STRUCT<id: STRING, name: STRING>"
_BRANCH = "STRUCT<branchId: STRING, branchName: STRING, isMain: BOOLEAN>"
#: Fields whose value as a number counts, beside the text.
_NUMBERS = ("revisionId", "id", "revNumber", "number")
_REVISION = f"STRUCT<{', '.join(f'{n}: VARIANT' for n in _NUMBERS)}, revName: STRING, name: STRING>"


def projects(responses: DataFrame) -> DataFrame:
    """Projects of all responses; a response without data holds none."""
    parsed = F.from_json("body", f"STRUCT<data: ARRAY<{_PROJECT}>>")
    return (responses.select(F.posexplode(parsed["data"]).alias("position", "p"))
            .select(F.col("p.id").alias("project_id"), F.col("p.name").alias("name"), "position"))


def branches(responses: DataFrame) -> DataFrame:
    """Branches of the projects in `project_id`."""
    parsed = F.from_json("body", f"STRUCT<data: STRUCT<branches: ARRAY<{_BRANCH}>>>")
    return (responses.select("project_id", F.posexplode(parsed["data"]["branches"]).alias("position", "b"))
            .select("project_id", F.col("b.branchId").alias("branch_id"), F.col("b.branchName").alias("branch_name"),
                    F.col("b.isMain").alias("is_main"), "position"))


def _whole(value: Column) -> Column:
    """The value if it is a whole JSON number; a text that spells one is none."""
    return F.when(F.schema_of_variant(value) == "BIGINT", value.try_cast("bigint"))


def revisions(responses: DataFrame) -> DataFrame:
    """Revision records as they stand, both spellings of each field, each number as text and, where it is a whole number, as
    `<field>_value`; the list is `data` or `data.revisions`.

    A body is parsed once, into a variant, and both places are looked up in that; a body that is no JSON holds none. The outer
    explode keeps the optimizer from parsing again for a filter on the list's size."""
    parsed = responses.select("project_id", F.try_parse_json("body").alias("v"))
    listed = F.coalesce(*(F.try_variant_get("v", path, f"ARRAY<{_REVISION}>") for path in ("$.data", "$.data.revisions")))
    found = (parsed.select("project_id", F.posexplode_outer(listed).alias("position", "r")).where(F.col("position").isNotNull()))
    return found.select(
        "project_id", "position", *(F.col(f"r.{n}").cast("string").alias(n) for n in _NUMBERS), "r.revName", "r.name",
        *(_whole(F.col(f"r.{n}")).alias(f"{n}_value") for n in _NUMBERS))


def database_types(responses: DataFrame) -> DataFrame:
    """Database type of each project, null where the response lacks it."""
    return responses.select("project_id", F.get_json_object("body", "$.data.projectInfo.dbType").alias("db_type"))
