"""One row for each request that would submit a payload. Nothing is sent."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F


def _given(identifier: str) -> Column:
    """An id that is neither missing nor 0."""
    return F.coalesce(F.col(identifier) != 0, F.lit(False))


def _body(fields: list[Column]) -> Column:
    """JSON of the fields, with the diagram only when one is named. Null fields are kept as null."""
    diagram = F.array(F.struct(F.lit(None).cast("string").alias("subjectArea"), F.col("diagram_name").alias("diagramName")))
    options = {"ignoreNullFields": "false"}
    return (F.when(F.length("diagram_name") > 0, F.to_json(F.struct(*fields, diagram.alias("addToDiagram")), options))
            .otherwise(F.to_json(F.struct(*fields), options)))


def _target() -> Column:
    branch = F.when(_given("branch_id"), F.concat(F.lit("/branches/"), F.col("branch_id").cast("string"))).otherwise("")
    revision = F.when(_given("revision_id"), F.col("revision_id").cast("string")).otherwise("last")
    return F.concat(F.lit("/projects/"), F.col("project_id").cast("string"), branch, F.lit("/revisions/"), revision)


def submissions(requests: DataFrame) -> DataFrame:
    """Target path and body of each submission: a new project where `project_id` is null, else a revision on the
    project or one of its branches. The payload is named by its folder in `payload_path`, not copied into the body."""
    is_new = F.col("project_id").isNull()
    source = F.lit("ddl").alias("sourceFormat")
    payload = F.col("payload_path").alias("payload")
    revision = F.col("revision_name").alias("revisionName")
    new = [F.col("db_type").alias("dbType"), F.col("project_name").alias("projectName"), source, payload, revision]
    old = [source, payload, F.col("strict").alias("strictMode"), revision]
    return requests.select("request_id", F.when(is_new, F.lit("/projects")).otherwise(_target()).alias("target"),
                           F.when(is_new, _body(new)).otherwise(_body(old)).alias("body"))


def branch_requests(requests: DataFrame) -> DataFrame:
    """Target path and body of each new branch."""
    body = F.to_json(F.struct(F.col("branch_name").alias("branchName"), F.col("revision_name").alias("revisionName")),
                     {"ignoreNullFields": "false"})
    target = F.concat(F.lit("/projects/"), F.col("project_id").cast("string"), F.lit("/branches"))
    return requests.select("request_id", target.alias("target"), body.alias("body"))


def envelope_bytes(**fields: object) -> int:
    """Bytes of a JSON body around its payload; add the payload's own to get the size that is limited."""
    return len(json.dumps({**fields, "payload": ""}))
