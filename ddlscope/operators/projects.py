"""Projects, branches and revisions of the modelling service, as stored lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ddlscope.functions.revisions import either_text, given, number_rank, revision_label, stated
from ddlscope.functions.text import normalized
from ddlscope.operators.positions import with_position


def _taken(proposals: DataFrame, proposed: str, existing: DataFrame, name: str, also: Sequence[str]) -> DataFrame:
    wanted = proposals.withColumn("_name", normalized(proposed)).where(F.col("_name") != "")
    # Without repeats, so that a name many projects share is one row and not one task's work.
    taken = existing.select(*also, normalized(F.coalesce(name, F.lit(""))).alias("_name")).distinct()
    return wanted.join(taken, [*also, "_name"], "left_semi").drop("_name")


def conflicting_projects(proposals: DataFrame, projects: DataFrame, proposed: str = "proposed_name") -> DataFrame:
    """Proposals whose name a project has already; a blank proposal never conflicts."""
    return _taken(proposals, proposed, projects, "name", ())


def conflicting_branches(proposals: DataFrame, branches: DataFrame, proposed: str = "proposed_name") -> DataFrame:
    """Proposals whose name a branch of the same project has already."""
    return _taken(proposals, proposed, branches, "branch_name", ("project_id",))


def resolve_projects(wanted: DataFrame, projects: DataFrame, name: str = "wanted_name",
                     arrival: str = "project_id") -> DataFrame:
    """Id of the first project of each wanted name, null without one; `arrival` says which is first, for one response the
    `position` in its list. Names are reduced to their first project before
    the join, so a repeated name does not multiply rows."""
    first = (projects.groupBy(normalized(F.coalesce("name", F.lit(""))).alias("_name"))
             .agg(F.min_by("project_id", arrival).alias("project_id")))
    return wanted.withColumn("_name", normalized(name)).join(first, "_name", "left").drop("_name")


def resolve_branches(wanted: DataFrame, branches: DataFrame, name: str = "wanted_name",
                     arrival: str = "branch_id") -> DataFrame:
    """Id of the first branch of exactly the wanted name in the wanted project, null without one."""
    first = (branches.groupBy("project_id", F.col("branch_name").alias(name))
             .agg(F.min_by("branch_id", arrival).alias("branch_id")))
    return wanted.join(first, ["project_id", name], "left")


def concurrent_projects(projects: DataFrame, branches: DataFrame) -> DataFrame:
    """Whether a project is worked on in branches: it has more than one, or one that is not the main one. A branch
    without the flag counts as main, and a project without branches is not worked on in them."""
    rule = (F.count("*") > 1) | F.bool_or(~F.coalesce("is_main", F.lit(True)))
    by_project = branches.groupBy("project_id").agg(rule.alias("concurrent"))
    return (projects.join(by_project, "project_id", "left")
            .select("project_id", F.coalesce("concurrent", F.lit(False)).alias("concurrent")))


def offered_branches(branches: DataFrame) -> DataFrame:
    """Branches that can be written to. Here a branch without the main flag counts as not main."""
    return branches.where(~F.coalesce("is_main", F.lit(False)))


def revision_records(raw: DataFrame) -> DataFrame:
    """Revisions with one value for each field out of its two spellings; those without an id are dropped. The number falls back
    on the id. `rev_rank` is what sorts them: the number if it is a whole one, else 0, also for a text that spells one."""
    named = raw.withColumn("_id", F.coalesce(given("revisionId"), stated("id"))).where(F.col("_id").isNotNull())
    numbered = named.withColumn("_number", F.coalesce(given("revNumber"), given("number"), "_id"))
    return (numbered.select("project_id", F.col("_id.text").alias("revision_id"), F.col("_number.text").alias("rev_number"),
                            either_text("revName", "name").alias("rev_name"),
                            F.coalesce("_number.value", F.lit(0).cast("bigint")).alias("rev_rank"))
            .withColumn("label", revision_label("rev_number", "rev_name")))


def newest_first(revisions: DataFrame, rank: str | None = None) -> DataFrame:
    """Place of each revision in its project's list, highest number first; a number that is no integer sorts as 0. `rank` names
    the column that sorts, as parsed records have one. Numbered without a window, since one project may hold much of all."""
    order = F.col(rank) if rank else number_rank("rev_number")
    return with_position(revisions, [order.desc(), F.col("revision_id")], ["project_id"], "place")


def by_name(names: DataFrame, name: str, identifier: str, group: Sequence[str] = ()) -> DataFrame:
    """Place of each project, or of each branch in its project, by lower-cased name."""
    order = [F.lower(F.coalesce(name, F.lit(""))), F.col(identifier)]
    return with_position(names, order, group, "place")
