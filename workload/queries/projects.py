"""Projects, branches and revisions."""

from pyspark.sql import functions as F

from ddlscope.functions.revisions import number_rank
from ddlscope.operators import projects, ranked
from ddlscope.session import scratch_path
from ddlscope.sources import responses
from workload.registry import query

_NAME = "lower(trim({}, ' ' || chr(9)))"


def _response(data, project="project_id"):
    """A stored response whose `data` is the given column."""
    return [F.col(project).alias("project_id"), F.to_json(F.struct(data.alias("data"))).alias("body")]


def project_responses(t):
    return t("fx_projects").select(*_response(F.array(F.struct(F.col("project_id").alias("id"), "name"))))


def branch_responses(t):
    branch = F.struct(F.col("branch_id").alias("branchId"), F.col("branch_name").alias("branchName"),
                      F.col("is_main").alias("isMain"))
    return t("fx_branches").select(*_response(F.struct(F.array(branch).alias("branches"))))


def revision_responses(t):
    """Both forms of the container, each with its own spelling of the fields, and responses without data."""
    def either(column, is_text):
        value = F.col(column).cast("bigint")
        return F.when(is_text, F.to_variant_object(F.array(value.cast("string")))).otherwise(F.to_variant_object(F.array(value)))

    def element(column, is_text):
        return F.variant_get(either(column, is_text), "$[0]", "variant")
    revisions = t("fx_revisions")
    number, identifier = element("rev_number", F.col("rev_number") % 5 == 0), element("revision_id", F.col("revision_id") % 3 == 0)
    as_list = F.array(F.struct(identifier.alias("revisionId"), number.alias("revNumber"), F.col("rev_name").alias("revName")))
    as_object = F.struct(F.array(F.struct(identifier.alias("id"), number.alias("number"), F.col("rev_name").alias("name"))).alias("revisions"))
    is_list = F.col("rev_name").isNull()
    return (revisions.where(is_list).select(*_response(as_list))
            .unionByName(revisions.where(~is_list).select(*_response(as_object)))
            .unionByName(revisions.select("project_id", F.lit("{}").alias("body"))))


@query("SELECT CAST(project_id AS STRING) AS project_id, name, 0 AS position FROM fx_projects")
def s10_projects(t):
    return responses.projects(project_responses(t))


@query("SELECT project_id, CAST(branch_id AS STRING) AS branch_id, branch_name, is_main, 0 AS position FROM fx_branches")
def s11_branches(t):
    return responses.branches(branch_responses(t))


# Every third id is a text in the response, and so is every fifth number.
@query("""WITH stated AS (SELECT *, CASE WHEN revision_id % 3 <> 0 THEN revision_id END AS id_value,
              CASE WHEN rev_number % 5 <> 0 THEN rev_number::BIGINT END AS number_value FROM fx_revisions)
          SELECT project_id, 0 AS position, CASE WHEN rev_name IS NULL THEN CAST(revision_id AS STRING) END AS "revisionId",
            CASE WHEN rev_name IS NOT NULL THEN CAST(revision_id AS STRING) END AS id,
            CASE WHEN rev_name IS NULL THEN id_value END AS "revisionId_value", CASE WHEN rev_name IS NOT NULL THEN id_value END AS id_value,
            CASE WHEN rev_name IS NULL THEN number_value END AS "revNumber_value",
            CASE WHEN rev_name IS NOT NULL THEN number_value END AS number_value,
            CASE WHEN rev_name IS NULL THEN CAST(rev_number AS STRING) END AS "revNumber",
            CASE WHEN rev_name IS NOT NULL THEN CAST(rev_number AS STRING) END AS number,
            CAST(NULL AS STRING) AS "revName", rev_name AS name FROM stated""")
def s12_revisions(t):
    return responses.revisions(revision_responses(t))


@query("""SELECT o_orderkey AS project_id, CASE o_orderstatus WHEN 'F' THEN 'postgreSQL' WHEN 'O' THEN 'snowflake' END
            AS db_type FROM orders""")
def s13_database_types(t):
    kind = F.when(F.col("o_orderstatus") == "F", "postgreSQL").when(F.col("o_orderstatus") == "O", "snowflake")
    info = F.struct(F.struct(kind.alias("dbType")).alias("projectInfo"))
    return responses.database_types(t("orders").select(*_response(info, "o_orderkey")))


@query("SELECT * FROM fx_branches WHERE NOT coalesce(is_main, false)")
def f9_offered_branches(t):
    return projects.offered_branches(t("fx_branches"))


# An id of 0 in the list form has no other spelling to fall back on, so it is no id, unless it is the text "0".
@query("""SELECT project_id, CAST(revision_id AS STRING) AS revision_id FROM fx_revisions
          WHERE rev_name IS NOT NULL OR revision_id <> 0 OR revision_id % 3 = 0""")
def f10_revisions_with_id(t):
    return projects.revision_records(responses.revisions(revision_responses(t))).select("project_id", "revision_id")


@query("""WITH taken AS (SELECT project_id, CAST(revision_id AS STRING) AS revision_id,
              CAST(coalesce(rev_number, revision_id) AS STRING) AS rev_number, coalesce(rev_name, '') AS rev_name,
              CASE WHEN rev_number % 5 <> 0 THEN rev_number WHEN rev_number IS NULL AND revision_id % 3 <> 0 THEN revision_id ELSE 0 END AS rev_rank
            FROM fx_revisions WHERE rev_name IS NOT NULL OR revision_id <> 0 OR revision_id % 3 = 0)
          SELECT *, trim('From revision ' || rev_number || ': ' || rev_name) AS label FROM taken""")
def c9_revision_records(t):
    return projects.revision_records(responses.revisions(revision_responses(t)))


@query(f"""SELECT * FROM fx_proposals p WHERE trim(proposed_name) <> '' AND EXISTS (SELECT 1 FROM fx_projects x
             WHERE {_NAME.format('x.name')} = {_NAME.format('p.proposed_name')})""")
def j6_project_conflicts(t):
    return projects.conflicting_projects(t("fx_proposals"), t("fx_projects"))


@query("""SELECT * FROM fx_branch_proposals p WHERE trim(proposed_name) <> '' AND EXISTS (SELECT 1 FROM fx_branches b
            WHERE b.project_id = p.project_id AND lower(trim(b.branch_name)) = lower(trim(p.proposed_name)))""")
def j6_branch_conflicts(t):
    return projects.conflicting_branches(t("fx_branch_proposals"), t("fx_branches"))


@query(f"""SELECT p.proposal_id, p.proposed_name AS wanted_name, x.project_id FROM fx_proposals p LEFT JOIN (
             SELECT {_NAME.format('name')} AS name, min(project_id) AS project_id FROM fx_projects GROUP BY 1) x
             ON x.name = {_NAME.format('p.proposed_name')}""")
def j10_resolve_projects(t):
    wanted = t("fx_proposals").select("proposal_id", F.col("proposed_name").alias("wanted_name"))
    return projects.resolve_projects(wanted, t("fx_projects"))


@query("""SELECT p.proposal_id, p.project_id, p.proposed_name AS wanted_name, b.branch_id FROM fx_branch_proposals p LEFT JOIN (
            SELECT project_id, branch_name, min(branch_id) AS branch_id FROM fx_branches GROUP BY ALL) b
            ON b.project_id = p.project_id AND b.branch_name = p.proposed_name""")
def j11_resolve_branches(t):
    wanted = t("fx_branch_proposals").withColumnRenamed("proposed_name", "wanted_name")
    return projects.resolve_branches(wanted, t("fx_branches"))


@query("""SELECT p.project_id, coalesce(b.concurrent, false) AS concurrent FROM fx_projects p LEFT JOIN (
            SELECT project_id, count(*) > 1 OR bool_or(NOT coalesce(is_main, true)) AS concurrent
            FROM fx_branches GROUP BY project_id) b ON b.project_id = p.project_id""")
def a13_concurrent_projects(t):
    return projects.concurrent_projects(t("fx_projects"), t("fx_branches"))


@query("""SELECT project_id, revision_id, rev_number, rev_name, row_number() OVER (PARTITION BY project_id
            ORDER BY coalesce(rev_number, 0) DESC, revision_id) AS place FROM fx_revisions""")
def w4_newest_first(t):
    return projects.newest_first(t("fx_revisions"))


# The same from rows stored in order: the newest ten of each project are in one or two parts.
@query("""SELECT project_id, revision_id, rev_number, rev_name, row_number() OVER (PARTITION BY project_id
            ORDER BY coalesce(rev_number, 0) DESC, revision_id) AS position, CAST(0 AS BIGINT) AS page FROM fx_revisions QUALIFY position <= 10""")
def w4_stored_newest(t):
    order = [number_rank("rev_number").desc(), F.col("revision_id")]
    return ranked.store(t("fx_revisions"), scratch_path(t.spark, "ranked"), order, ["project_id"]).page(0, 10)


@query("SELECT project_id, name, row_number() OVER (ORDER BY lower(name), project_id) AS place FROM fx_projects")
def o3_projects_by_name(t):
    return projects.by_name(t("fx_projects"), "name", "project_id")


@query("""SELECT project_id, branch_id, branch_name, row_number() OVER (PARTITION BY project_id
            ORDER BY lower(branch_name), branch_id) AS place FROM fx_branches""")
def o3_branches_by_name(t):
    return projects.by_name(t("fx_branches").drop("is_main"), "branch_name", "branch_id", ["project_id"])
