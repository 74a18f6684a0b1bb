"""Operators on small tables made by hand, hot groups among them."""

import glob
import gzip
import json
import os

from pyspark.sql import functions as F

from ddlscope import schemas
from ddlscope.functions.text import listing_order
from ddlscope.operators import catalogs, failures, listing, outcomes, paging, progress, projects, selection, sizing
from ddlscope.operators.positions import with_position
from ddlscope.plans import importing
from ddlscope.sinks import manifest, payload
from ddlscope.sources import responses, snapshots


def rows(frame, *columns):
    return sorted(tuple(r) for r in (frame.select(*columns) if columns else frame).collect())


def test_positions_of_a_hot_group_equal_a_sort(spark):
    """One group holds most rows and spans several partitions; null is a group like any other."""
    hot = spark.range(20_000).select(F.lit("hot").alias("g"), (F.col("id") * 7919 % 20_011).alias("v"))
    other = spark.range(500).select(F.when(F.col("id") % 3 > 0, F.concat(F.lit("g"), (F.col("id") % 40).cast("string"))).alias("g"),
                                    F.col("id").alias("v"))
    data = hot.unionByName(other)
    found = with_position(data, [F.col("v").desc()], ["g"], total="n")
    wanted = {}
    for g, v in sorted((tuple(r) for r in data.collect()), key=lambda r: (r[0] or "", -r[1])):
        wanted.setdefault(g, []).append(v)
    result = [tuple(r) for r in found.collect()]
    assert len(result) == 20_500
    assert all(wanted[g][p - 1] == v and n == len(wanted[g]) for g, v, p, n in result)


def test_positions_spread_a_hot_group_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = with_position(spark.range(10_000).withColumn("g", F.lit(1)), [F.col("id")], ["g"])
        in_partition = found.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert in_partition < 6_000 and found.agg(F.max("position")).first()[0] == 10_000


def test_positions_without_a_group(spark):
    found = with_position(spark.range(1_000), [F.col("id").desc()])
    assert found.where("position <> 1000 - id").count() == 0


def test_listing_with_lead_keys_names_with_dots_and_case(spark):
    tables = spark.createDataFrame([
        (1, "main", "a.b", "c", False), (1, "main", "a", "b.c", None), (1, "main", "a", "V", False), (1, "main", "a", "v", False),
        (1, "main", "a", "tmp", True), (1, "main", "a", "Stream", False), (2, "main", "a", "Stream", False)],
        "snapshot_id int, " + schemas.TABLES)
    views = spark.createDataFrame([
        (1, "main", "a", "v", False, None), (1, "main", "a.b", "c", True, True), (1, "main", "a", "b.c", False, True)],
        "snapshot_id int, " + schemas.VIEWS)
    information = spark.createDataFrame([
        (1, "main", "a", "STREAM", "STREAMING_TABLE"), (1, "main", "a", "v", "VIEW"),
        (2, "hive_metastore", "a", "stream", "STREAMING_TABLE")], "snapshot_id int, " + schemas.INFORMATION_TABLES)
    foreign = spark.createDataFrame([(1, "elsewhere")], "snapshot_id int, catalog_name string")
    lead = ["snapshot_id"]
    streaming = snapshots.streaming_table_names(information, foreign, lead)
    found = listing.list_objects(tables, views, streaming, lead=lead)
    assert rows(found) == [
        (1, "main", "a", "V", "TABLE"), (1, "main", "a", "b.c", "MATERIALIZED VIEW"), (1, "main", "a", "v", "VIEW"),
        (1, "main", "a.b", "c", "TABLE"), (2, "main", "a", "Stream", "TABLE")]
    # Without tables nothing is looked up as a streaming table, and only views stay.
    assert rows(listing.list_objects(tables, views, streaming, want_tables=False, lead=lead), "object_name") == [("b.c",), ("v",)]
    assert rows(listing.excluded_counts(listing.streaming_only(snapshots.tables(tables), streaming, lead), lead)) == [
        (1, "main", "a", "STREAMING TABLE", 1)]


def test_every_listed_row_is_kept_excluded_or_filtered(spark):
    from tests.conftest import SMALL
    from workload.queries.listing import all_objects, snapshot
    from workload.registry import Tables
    t = Tables(spark, SMALL)
    tables = t("fx_tables")
    excluded = listing.streaming_only(snapshots.tables(tables), snapshot(t).streaming())
    for options in ({}, {"want_views": False}, {"pattern": "fact_*"}):
        pattern = options.get("pattern", "")
        permanent = snapshots.tables(tables, pattern).count()
        dropped = excluded.where(F.col("object_name").rlike("(?i)^fact_")).count() if pattern else excluded.count()
        views = 0 if options.get("want_views", True) else all_objects(t, want_tables=True).where("kind LIKE '%VIEW'").count()
        assert all_objects(t, **options).count() + dropped + views == permanent


def test_repeated_views_do_not_multiply_rows(spark):
    tables = spark.createDataFrame([("c", "s", "v")], "catalog_name string, schema_name string, object_name string")
    views = spark.createDataFrame([("c", "s", "v", "MATERIALIZED VIEW", 1), ("c", "s", "v", "VIEW", 2)],
                                  "catalog_name string, schema_name string, object_name string, kind string, seen int")
    assert rows(listing.with_view_kinds(tables, views, arrival="seen")) == [("c", "s", "v", "VIEW")]
    assert listing.with_view_kinds(tables, views).count() == 1


def test_catalog_properties_and_connections(spark):
    properties = spark.createDataFrame([
        ("a", " Catalog Type\t", " foreign_catalog "), ("a", "CONNECTION NAME", " c1 "), ("b", "Owner", "x"),
        ("c", "Catalog Type", None), ("c", "Connection Name", "")], schemas.CATALOG_PROPERTIES)
    found = snapshots.catalog_properties(properties)
    assert sorted(tuple(r) for r in found.fillna("-").collect()) == [("a", "FOREIGN_CATALOG", "c1"), ("b", "", "-"), ("c", "", "-")]
    assert rows(catalogs.foreign_catalogs(found)) == [("a",)]
    connections = snapshots.connections(spark.createDataFrame([("c1", "MYSQL", "h", None)], schemas.CONNECTIONS))
    joined = catalogs.with_connection(found, connections)
    assert rows(joined, "catalog_name", "connection_type", "host", "port") == [
        ("a", "MYSQL", "h", ""), ("b", "", "", ""), ("c", "", "", "")]


def test_governed_workspaces(spark):
    given = [(1, "spark_catalog"), (1, "samples"), (2, "hive_metastore"), (3, "samples"), (3, "sales"), (4, "system")]
    found = catalogs.governed_workspaces(spark.createDataFrame(given, "workspace_id int, catalog_name string"))
    assert rows(found) == [(1, False), (2, True), (3, True), (4, True)]


def _objects(spark, data):
    return spark.createDataFrame(data, schemas.OBJECTS)


def test_selection_and_work_left(spark):
    objects = _objects(spark, [("c", "s", "a", "TABLE", "x"), ("c", "s", "b", "TABLE", None), ("c", "s", "d", "TABLE", ""),
                               ("c", "z", "e", "VIEW", None)])
    chosen = spark.createDataFrame([("c", "s", "a", True), ("c", "s", "b", True), ("c", "s", "d", True), ("c", "gone", "a", True)],
                                   schemas.SELECTION)
    selected = selection.with_selection(objects, chosen)
    assert rows(selection.to_export(selected), "object_name") == [("a",)]
    assert rows(selection.to_generate(selected), "object_name") == [("b",)]
    assert rows(selection.schema_counts(selected)) == [("c", "s", 3, 3), ("c", "z", 0, 1)]
    total = selection.schema_counts(selected).agg(F.sum("selected"), F.sum("total")).first()
    assert tuple(total) == tuple(selection.selection_counts(selected, []).first())
    toggled = selection.select_where(selected, F.col("object_name") == "b", False)
    assert rows(toggled.where("selected"), "object_name") == [("a",), ("d",)]


def test_pages(spark):
    matches = spark.range(7).select(F.lit("c").alias("catalog_name"), F.lit("s").alias("schema_name"),
                                    F.concat(F.lit("t"), F.col("id").cast("string")).alias("object_name"))
    paged = paging.paginate(matches, 3)

    def shown(index):
        return rows(paged.where(paging.on_page(index)), "object_name", "page", "pages", "first_row", "last_row", "matches")
    assert shown(1) == [("t3", 1, 3, 4, 6, 7), ("t4", 1, 3, 4, 6, 7), ("t5", 1, 3, 4, 6, 7)]
    assert shown(99) == [("t6", 2, 3, 7, 7, 7)] and shown(-5) == shown(0)
    for index in (-5, 0, 1, 2, 99):
        assert rows(paging.one_page(matches, index, 3), "object_name", "page") == [(r[0], r[1]) for r in shown(index)]
    groups = spark.createDataFrame([("c",), ("empty",)], "catalog_name string")
    summary = paging.page_summary(groups, matches, 99, 3)
    assert rows(summary, "catalog_name", "matches", "pages", "page", "first_row", "last_row") == [
        ("c", 7, 3, 2, 7, 7), ("empty", 0, 1, 0, 0, 0)]


def test_write_back_takes_the_kind_from_the_text(spark):
    listed = spark.createDataFrame([("c", "s", "a", "TABLE"), ("c", "s", "b", "VIEW"), ("c", "s", "x", "TABLE")],
                                   "catalog_name string, schema_name string, object_name string, kind string")
    log = spark.createDataFrame([("c", "s", "a", "CREATE STREAMING TABLE a", 1), ("c", "s", "b", "old", 1), ("c", "s", "b", "select", 2),
                                 ("c", "s", "b", None, 3)],
                                "catalog_name string, schema_name string, object_name string, ddl string, ts int")
    known = outcomes.write_back(listed, outcomes.latest_ddl(log, "ts"))
    assert rows(known.fillna("-"), "object_name", "kind", "ddl") == [
        ("a", "STREAMING TABLE", "CREATE STREAMING TABLE a"), ("b", "VIEW", "select"), ("x", "TABLE", "-")]
    assert rows(outcomes.without(known, outcomes.unsupported(known)), "object_name") == [("b",), ("x",)]


def test_failure_groups_with_one_reason_holding_most(spark):
    failed = failures.failures(spark.range(5_000).select(
        F.lit("c").alias("catalog_name"), F.concat(F.lit("s.x"), (F.col("id") % 3).cast("string")).alias("schema_name"),
        F.concat(F.lit("o"), F.col("id").cast("string")).alias("object_name"), (5_000 - F.col("id")).alias("seen"),
        F.when(F.col("id") % 100 == 0, F.concat(F.lit("rare "), (F.col("id") % 2_000).cast("string")))
        .when(F.col("id") == 7, "cancelled").otherwise(F.concat(F.lit("PERMISSION_DENIED "), F.lit("z" * 700))).alias("reason")))
    top = failures.failure_groups(failed, ["seen"]).orderBy("place").collect()
    assert [r.place for r in top] == list(range(1, 9))
    assert top[0].failures == 4_949 and len(top[0].reason) == 600 and top[0].examples == "s.x1.o4999, s.x0.o4998, s.x2.o4997"
    # Of the rare reasons, those up to 900 come three times and the others twice.
    assert [r.reason for r in top[1:]] == sorted("rare " + str(100 * i) for i in range(10))[:7]
    by_class = failures.failure_groups(failed, ["seen"], ["permission"])
    assert by_class.where("permission").count() == 1 and by_class.where("NOT permission").count() == 8
    # Schemas with a dot in the name stay whole.
    assert rows(failures.denied_schemas(failed), "schema_name") == [("s.x0",), ("s.x1",), ("s.x2",)]


def test_access(spark):
    objects = _objects(spark, [("c", "s", "B", "T", None), ("c", "s", "a", "T", None), ("c", "z", "A", "T", None),
                               ("c", "z", "a", "T", None), ("d", "s", "q", "T", None)])
    assert rows(failures.access_sample(objects), "catalog_name", "schema_name", "object_name") == [
        ("c", "s", "a"), ("c", "z", "A"), ("d", "s", "q")]
    denied = spark.createDataFrame([("c", "z"), ("d", "s"), ("e", "s")], schemas.SCHEMAS)
    assert failures.objects_in(objects, denied).count() == 3
    assert rows(failures.fully_denied_catalogs(objects, denied)) == [("c", 2, 1, False), ("d", 1, 1, True)]
    granted = failures.grants(denied.where("catalog_name = 'c'"), "me`x").orderBy("catalog_name", "schema_name", "ord")
    assert [r.statement for r in granted.collect()] == [
        "GRANT USE CATALOG ON CATALOG `c` TO `me``x`;", "GRANT USE SCHEMA ON SCHEMA `c`.`z` TO `me``x`;",
        "GRANT SELECT ON SCHEMA `c`.`z` TO `me``x`;"]
    many = spark.range(7).select(F.lit("c").alias("catalog_name"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("schema_name"))
    assert rows(failures.named_schemas(many)) == [("c", 7, "s0, s1, s2, s3, s4, …")]
    assert rows(failures.named_schemas(many.limit(5).where("schema_name < 's2'"))) == [("c", 2, "s0, s1")]


def test_skipped_schemas(spark):
    status = spark.createDataFrame([("c", f"s{i:02}", "x" * 200 + "\nmore JVM stacktrace: y") for i in range(30)] + [("c", "ok", None)],
                                   schemas.SCHEMA_STATUS)
    found = listing.skipped_schemas(status).orderBy("schema_name").collect()
    assert [r.schema_name for r in found] == [f"s{i:02}" for i in range(25)] and {len(r.reason) for r in found} == {120}
    assert {r.more for r in found} == {5}


def test_skipped_schemas_of_each_catalog_and_day(spark):
    status = spark.createDataFrame([(day, c, f"s{i:02}", "boom") for day in (1, 2) for c in "ab" for i in range(20)] + [(1, "c", "ok", None)],
                                   "day int, catalog_name string, schema_name string, reason string")
    found = listing.skipped_schemas(status, ["day"], shown=15)
    assert rows(found.groupBy("day", "catalog_name").agg(F.count("*").alias("n"), F.max("more").alias("more")), "day", "catalog_name", "n", "more") == [
        (1, "a", 15, 5), (1, "b", 15, 5), (2, "a", 15, 5), (2, "b", 15, 5)]


def test_summary_has_catalogs_of_either_side(spark):
    listed = spark.createDataFrame([("a", "s", "t", "TABLE")] * 2, schemas.OBJECTS.replace(", ddl string", ""))
    status = spark.createDataFrame([("b", "s", "boom"), ("b", "r", None)], schemas.SCHEMA_STATUS)
    assert rows(listing.listing_summary(listed, status), "catalog_name", "schemas", "failed_schemas", "objects") == [("a", 0, 0, 2), ("b", 2, 1, 0)]


def _texts(path, catalog):
    parts = sorted(glob.glob(os.path.join(path, f"catalog_name={catalog}", "part-*.gz")))
    return len(parts), b"".join(open(p, "rb").read() for p in parts)


def test_payload_files_are_the_payload_in_order(spark, folder):
    """Many objects in one schema, so that it spans files; concatenated gzip files are one gzip stream."""
    objects = spark.range(3_000).select(
        F.when(F.col("id") % 10 == 0, "a+b c/d").otherwise("main").alias("catalog_name"),
        F.when(F.col("id") % 7 == 0, "z").otherwise("big").alias("schema_name"),
        F.concat(F.when(F.col("id") % 2 == 0, "T").otherwise("t"), F.md5(F.col("id").cast("string"))).alias("object_name"),
        F.concat(F.lit("CREATE TABLE main.s.t -- "), F.col("id").cast("string"), F.lit("\n\r  é\r\n\n")).alias("ddl"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        payload.write_payload(objects, f"{folder}/out")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files, packed = _texts(f"{folder}/out", "main")
    kept = [r for r in objects.collect() if r.catalog_name == "main"]
    kept.sort(key=lambda r: (r.schema_name, r.object_name.lower(), r.object_name))
    wanted = "\n".join(f"-- {r.schema_name}.{r.object_name}\n{r.ddl.replace('main.', '')};\n" for r in kept)
    assert files > 1 and gzip.decompress(packed).decode() == wanted + "\n"
    sizes = sizing.payload_sizes(sizing.with_chunk(objects)).where("catalog_name = 'main'").first()
    assert (sizes.objects, sizes.raw_bytes) == (len(kept), len(wanted.encode()))
    written = payload.text_sizes(spark, f"{folder}/out").where("catalog_name = 'main'").first()
    assert (written.raw_bytes, written.body_bytes) == (sizes.raw_bytes, sizes.body_bytes)
    assert sizes.body_bytes == len(json.dumps(wanted)) - 2
    wire = {r.catalog_name: (r.wire_bytes, r.files) for r in payload.wire_sizes(spark, f"{folder}/out").collect()}
    assert set(wire) == {"main", "a+b c/d"} and wire["main"] == (len(packed), files)


def test_preview(spark):
    objects = _objects(spark, [("c", "s", f"t{i:03}", "TABLE", f"d{i}") for i in range(20)])
    found = sizing.preview(objects, objects, 5).orderBy("position").collect()
    assert [(r.position, r.chunk) for r in found] == [(i + 1, f"-- s.t{i:03}\nd{i};\n") for i in range(5)]
    assert rows(sizing.preview_counts(objects, 5)) == [("c", 20, 5)]


def test_preview_of_each_catalog_agrees_with_its_counts(spark):
    objects = _objects(spark, [(c, "s", f"t{i:03}", "TABLE", f"d{i}") for c, n in (("a", 9), ("b", 3)) for i in range(n)])
    found = sizing.preview(objects, objects, 5)
    assert rows(found.groupBy("catalog_name").agg(F.count("*").alias("shown"), F.max("position").alias("last"))) == [("a", 5, 5), ("b", 3, 3)]
    assert rows(sizing.preview_counts(objects, 5)) == [("a", 9, 5), ("b", 3, 3)]


def test_manifest(spark):
    requests = spark.createDataFrame([
        (1, None, None, None, "New \"p\"", "postgreSQL", "r", None, "Diagram", "f/1"), (2, 5, 0, None, None, None, "r", True, "", "f/2"),
        (3, 5, 6, 7, None, None, None, False, None, "f/3")],
        "request_id int, project_id long, branch_id long, revision_id long, project_name string, db_type string, "
        "revision_name string, strict boolean, diagram_name string, payload_path string")
    found = {r.request_id: (r.target, r.body) for r in manifest.submissions(requests).collect()}
    assert found == {
        1: ("/projects", '{"dbType":"postgreSQL","projectName":"New \\"p\\"","sourceFormat":"ddl","payload":"f/1","revisionName":"r",'
                         '"addToDiagram":[{"subjectArea":null,"diagramName":"Diagram"}]}'),
        2: ("/projects/5/revisions/last", '{"sourceFormat":"ddl","payload":"f/2","strictMode":true,"revisionName":"r"}'),
        3: ("/projects/5/branches/6/revisions/7", '{"sourceFormat":"ddl","payload":"f/3","strictMode":false,"revisionName":null}')}


def test_responses(spark):
    bodies = spark.createDataFrame([
        (1, '{"data": [{"revisionId": 7, "revNumber": 3, "revName": "n"}, {"id": 8, "number": "v2"}, {"revName": "no id"}]}'),
        (2, '{"data": {"revisions": [{"id": 9, "name": "m"}]}}'), (3, '{"data": {"revisions": null}}'), (4, '{"data": []}'),
        (5, "{}"), (6, '{"data": null}'), (7, "not json"), (8, '{"data": {}}')], schemas.RESPONSES)
    records = projects.revision_records(responses.revisions(bodies))
    assert rows(records) == [(1, "7", "3", "n", 3, "From revision 3: n"), (1, "8", "v2", "", 0, "From revision v2:"),
                             (2, "9", "9", "m", 9, "From revision 9: m")]
    odd = spark.createDataFrame([(1, '{"data": [{"revisionId": "a1b2", "revNumber": "30"}, {"revisionId": 0, "id": "77", "number": 4}, {"id": 5, "revNumber": 0, "number": ""}]}')],
                                schemas.RESPONSES)
    placed = projects.newest_first(projects.revision_records(responses.revisions(odd)), "rev_rank")
    assert rows(placed, "revision_id", "rev_number", "rev_rank", "place") == [("5", "5", 5, 1), ("77", "4", 4, 2), ("a1b2", "30", 0, 3)]
    named = responses.projects(spark.createDataFrame([(0, '{"data": [{"id": 2, "name": "Sales"}, {"id": "x1", "name": "sales"}]}')], schemas.RESPONSES))
    wanted = spark.createDataFrame([("SALES ",)], "wanted_name string")
    assert projects.resolve_projects(wanted, named, arrival="position").first()["project_id"] == "2"
    listed = spark.createDataFrame([(0, '{"data": [{"id": 1, "name": "a"}, {"id": 2}]}'), (0, '{"data": null}'), (0, "{}")], schemas.RESPONSES)
    assert sorted((r.project_id, r.name or "-") for r in responses.projects(listed).collect()) == [("1", "a"), ("2", "-")]
    branched = spark.createDataFrame([(1, '{"data": {"branches": [{"branchId": 4, "branchName": "m", "isMain": true}, {"branchId": 5}]}}'),
                                      (2, '{"data": {}}'), (3, "{}")], schemas.RESPONSES)
    assert [tuple(r) for r in responses.branches(branched).collect()] == [(1, "4", "m", True, 0), (1, "5", None, None, 1)]
    typed = spark.createDataFrame([(1, '{"data": {"projectInfo": {"dbType": "x"}}}'), (2, '{"data": {}}'), (3, "oops")], schemas.RESPONSES)
    assert [r.db_type for r in responses.database_types(typed).orderBy("project_id").collect()] == ["x", None, None]


def test_projects_and_branches(spark):
    listed = spark.createDataFrame([(1, " Sales\t"), (2, "sales"), (3, None), (4, "solo"), (5, "main only")], schemas.PROJECTS)
    branches = spark.createDataFrame([(1, 11, "main", True), (1, 12, "B", None), (2, 21, "x", False), (4, 41, "m", None),
                                      (5, 51, "main", True)], schemas.BRANCHES)
    assert rows(projects.concurrent_projects(listed, branches)) == [(1, True), (2, True), (3, False), (4, False), (5, False)]
    assert rows(projects.offered_branches(branches), "branch_id") == [(12,), (21,), (41,)]
    proposals = spark.createDataFrame([(1, "SALES ", 1), (2, " ", 1), (3, "new", 1), (4, "b", 1), (5, "B", 2)],
                                      "id int, proposed_name string, project_id long")
    assert rows(projects.conflicting_projects(proposals, listed), "id") == [(1,)]
    assert rows(projects.conflicting_branches(proposals, branches), "id") == [(4,)]
    wanted = proposals.select("id", F.col("proposed_name").alias("wanted_name"), "project_id")
    resolved = projects.resolve_projects(wanted.drop("project_id"), listed)
    assert rows(resolved.where("project_id IS NOT NULL"), "id", "project_id") == [(1, 1), (2, 3)]
    assert rows(projects.resolve_branches(wanted, branches).where("branch_id IS NOT NULL"), "id", "branch_id") == []
    revisions = spark.createDataFrame([(1, 1, "5", ""), (1, 2, "12", ""), (1, 3, "v9", ""), (1, 4, None, "")], schemas.REVISIONS)
    assert [r.revision_id for r in projects.newest_first(revisions).orderBy("place").collect()] == [2, 1, 3, 4]


def test_progress(spark):
    done = spark.createDataFrame([(i, f"2024-01-01 00:00:{i:02}", 1, "TABLE", "x" if i % 2 else None) for i in range(10)],
                                 "attempt_id long, ts string, run_id int, kind string, reason string")
    done = done.withColumn("ts", F.to_timestamp("ts"))
    work = spark.createDataFrame([(1, 110)], "run_id int, total long")
    assert tuple(progress.run_progress(done, work).first()) == (1, 10, 110, 9.0, 90.0, False)
    log = progress.progress_log(done, work).orderBy("done").collect()
    assert [(r.attempt_id, r.done, r.elapsed) for r in log] == [(i, i + 1, float(i)) for i in range(10)]
    assert log[3].eta == 3.0 / 4 * 106 and log[8].eta_shown == (8.0 / 9 * 101 > 90)
    none = work.where("run_id = 2")
    assert tuple(progress.run_progress(done, none).first()) == (1, 10, None, 9.0, None, None)
    assert progress.progress_log(done, none).count() == 10


def test_import_from_listing_to_files(spark, folder):
    """The steps together, on two catalogs."""
    tables = spark.createDataFrame([("main", "s", "t", False), ("main", "s", "v", False), ("main", "bad", "x", False),
                                    ("main", "s", "late", False), ("far", "s", "t", False)], schemas.TABLES)
    snapshot = importing.Snapshot(
        tables=tables, views=spark.createDataFrame([("main", "s", "v", False, False)], schemas.VIEWS),
        information=spark.createDataFrame([("far", "s", "t", "STREAMING_TABLE")], schemas.INFORMATION_TABLES),
        properties=spark.createDataFrame([("far", "Catalog Type", "FOREIGN_CATALOG")], schemas.CATALOG_PROPERTIES),
        schema_status=spark.createDataFrame([("main", "s", None), ("main", "bad", "boom"), ("far", "s", None)], schemas.SCHEMA_STATUS),
        ddl=spark.createDataFrame([("main", "s", "t", "CREATE TABLE main.s.t (x INT)"), ("main", "s", "v", "CREATE VIEW main.s.v AS SELECT 1"),
                                   ("main", "s", "late", "CREATE STREAMING TABLE main.s.late"), ("far", "s", "t", "CREATE TABLE far.s.t (y INT)")],
                                  schemas.DDL),
        selection=tables.select("catalog_name", "schema_name", "object_name", F.lit(True).alias("selected")))
    listed = importing.list_objects(snapshot)
    # The failed schema is skipped. Foreign catalogs are not asked for streaming tables.
    assert rows(listed, "catalog_name", "object_name") == [("far", "t"), ("main", "late"), ("main", "t"), ("main", "v")]
    assert rows(importing.sample_access(snapshot, listed), "catalog_name", "object_name", "kind") == [
        ("far", "t", "TABLE"), ("main", "late", "STREAMING TABLE")]
    verdicts = importing.export(importing.resolve(snapshot, listed), f"{folder}/out", raw_limit=60)
    assert rows(verdicts, "catalog_name", "objects", "preview_verdict", "submit_verdict") == [
        ("far", 1, "ok", "ok"), ("main", 2, "uncompressed", "uncompressed")]
    _, packed = _texts(f"{folder}/out", "main")
    assert gzip.decompress(packed).decode() == "-- s.t\nCREATE TABLE s.t (x INT);\n\n-- s.v\nCREATE VIEW s.v AS SELECT 1;\n\n"


def test_export_of_two_days_to_a_path_that_names_a_catalog(spark, folder):
    """Each day and catalog is a payload of its own; null and empty catalogs are one; no size is taken for another's."""
    objects = spark.createDataFrame([(day, c, "s", "t", "TABLE", f"CREATE TABLE {c}.s.t (x INT)", True) for day in (1, 2) for c in ("main", "a b", None)]
                                    + [(2, "", "s", "u", "TABLE", "CREATE VIEW v", True)],
                                    "day int, catalog_name string, schema_name string, object_name string, kind string, ddl string, selected boolean")
    verdicts = importing.export(objects, f"{folder}/catalog_name=x/out", raw_limit=60, wire_limit=10, lead=["day"], partitions=3)
    got = {(r.day, r.catalog_name): (r.objects, r.preview_verdict, r.submit_verdict) for r in verdicts.collect()}
    one = (1, "ok", "compressed")
    assert got == {("1", "main"): one, ("2", "main"): one, ("1", "a b"): one, ("2", "a b"): one, ("1", None): one, ("2", None): (2, "uncompressed", "uncompressed")}
    assert rows(payload.read_payload(spark, f"{folder}/catalog_name=x/out", ["day"]).where("catalog_name = 'main'").groupBy("day").count()) == [
        ("1", 3), ("2", 3)]


def test_import_takes_the_last_text_and_the_last_view(spark):
    tables = spark.createDataFrame([("c", "s", "v", False)], schemas.TABLES)
    views = spark.createDataFrame([("c", "s", "v", False, True, 1), ("c", "s", "v", False, False, 2)], schemas.VIEWS + ", ts int")
    texts = spark.createDataFrame([("c", "s", "v", "CREATE VIEW new", 5), ("c", "s", "v", "CREATE VIEW old", 3), ("c", "s", "v", None, 9)], schemas.DDL + ", ts int")
    status = spark.createDataFrame([("c", "s", None)], schemas.SCHEMA_STATUS)
    snapshot = importing.Snapshot(
        tables=tables, views=views, information=spark.createDataFrame([], schemas.INFORMATION_TABLES),
        properties=spark.createDataFrame([], schemas.CATALOG_PROPERTIES), schema_status=status, ddl=texts,
        selection=tables.select("catalog_name", "schema_name", "object_name", F.lit(True).alias("selected")), view_arrival="ts", ddl_arrival="ts")
    listed = importing.list_objects(snapshot)
    assert rows(listed, "object_name", "kind") == [("v", "VIEW")]
    assert rows(importing.resolve(snapshot, listed), "object_name", "ddl") == [("v", "CREATE VIEW new")]


def test_access_check(spark):
    listed = spark.createDataFrame([("a", s, o, "TABLE") for s in ("s1", "s2") for o in ("t1", "t2")] + [("b", "s", "t", "TABLE")],
                                   "catalog_name string, schema_name string, object_name string, kind string")
    reasons = spark.createDataFrame([("a", "s1", "t1", "X: [PERMISSION_DENIED] no"), ("a", "s1", "t2", None), ("a", "s2", "t1", "X: timeout"),
                                     ("b", "s", "t", "X: [PERMISSION_DENIED] no")],
                                    "catalog_name string, schema_name string, object_name string, reason string")
    found = importing.access_check(listed, reasons, "team")
    assert rows(found.catalogs, "catalog_name", "schemas", "denied_schemas", "all_denied", "affected") == [("a", 2, 1, False, 2), ("b", 1, 1, True, 1)]
    assert rows(found.denied) == [("a", "s1"), ("b", "s")] and found.grants.count() == 6 and found.affected.count() == 3
    assert rows(found.split, "permission", "failures") == [(False, 1), (True, 2)]


def test_listing_order_is_deterministic_for_names_that_differ_in_case(spark):
    names = _objects(spark, [("c", "s", n, "T", None) for n in ("b", "B", "a", "C")])
    assert [r.object_name for r in names.orderBy(*listing_order()).collect()] == ["a", "B", "b", "C"]
