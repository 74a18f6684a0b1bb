"""A store of generated texts over several generations, runs that are cut short, and sessions."""

import contextlib
import io
import re

import pytest

from ddlscope.operators.outcomes import write_back
from ddlscope.sinks.harvest import Harvest

OBJECTS = "catalog_name string, schema_name string, object_name string, kind string, ddl string, selected boolean"


def objects(spark, *names, ddl="CREATE VIEW x", selected=True):
    return spark.createDataFrame([("c", "s", n, "TABLE", ddl and f"{ddl} {n}", selected) for n in names], OBJECTS)


def names(rows):
    return sorted(r["object_name"] for r in rows.collect())


def texts(store):
    return sorted((r["object_name"], r["ddl"], r["kind"], r["generation"]) for r in store.texts().collect())


def plan(frame):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        frame.explain("formatted")
    return out.getvalue()


def test_generations_add_what_is_missing_and_replace_on_request(spark, folder):
    store = Harvest(spark, folder, buckets=3)
    everything = objects(spark, "a", "b", "d", "e")
    assert names(store.remaining(everything)) == ["a", "b", "d", "e"] and texts(store) == []
    assert store.add(objects(spark, "a", "b").union(objects(spark, "d", ddl=None))) == 1
    assert names(store.remaining(everything)) == ["d", "e"]
    assert names(store.remaining(everything.union(objects(spark, "f", selected=False)))) == ["d", "e"]
    assert store.add(objects(spark, "b", "d", "d", ddl="CREATE TABLE y")) == 2
    assert texts(store) == [("a", "CREATE VIEW x a", "VIEW", 1), ("b", "CREATE VIEW x b", "VIEW", 1), ("d", "CREATE TABLE y d", "TABLE", 2)]
    assert store.add(objects(spark, "a", ddl="CREATE TABLE z"), replace=True) == 3
    assert texts(store)[0] == ("a", "CREATE TABLE z a", "TABLE", 3)
    assert names(store.remaining(everything)) == ["e"]
    assert sorted((r["generation"], r["objects"]) for r in store.markers().collect()) == [(1, 2), (2, 1), (3, 1)]
    back = store.write_back(everything.drop("ddl"))
    wanted = write_back(everything, store.texts().select("catalog_name", "schema_name", "object_name", "ddl"))
    assert sorted(map(tuple, back.drop("generation").collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)


def test_a_generation_without_its_marker_does_not_count(spark, folder, monkeypatch):
    store = Harvest(spark, folder, buckets=2)
    store.add(objects(spark, "a"))
    with monkeypatch.context() as patch:
        # The rows are written; the driver is lost before the marker is.
        patch.setattr(type(spark), "createDataFrame", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            made = store.known()  # any frame of the store's keys will do
            store.add(made.selectExpr("catalog_name", "schema_name", "'b' AS object_name", "'CREATE TABLE b' AS ddl"))
    assert [t[0] for t in texts(store)] == ["a"] and names(store.remaining(objects(spark, "b"))) == ["b"]
    assert store.add(objects(spark, "b")) == 2
    assert [(t[0], t[3]) for t in texts(store)] == [("a", 1), ("b", 2)]


def test_another_session_finds_the_store(spark, folder):
    Harvest(spark, folder, buckets=2).add(objects(spark, "a"))
    spark.catalog.currentDatabase()
    store = Harvest(spark, folder, buckets=2)
    spark.sql(f"DROP TABLE {store.table}")  # what another session's catalog does not know
    again = Harvest(spark, folder, buckets=2)
    assert names(again.known()) == ["a"] and again.add(objects(spark, "a", "b")) == 2


def test_the_stored_side_is_not_shuffled(spark, folder):
    store = Harvest(spark, folder, buckets=5)
    store.add(objects(spark, "a", "b"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        listed = objects(spark, "a", "b", "c")
        for frame, scans in ((store.remaining(listed), "token"), (store.write_back(listed), "ddl")):
            text = plan(frame)
            assert text.count("Exchange hashpartitioning") <= 1 and len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1
            assert "Bucketed: true" in text
        assert "ddl" not in re.search(r"Scan parquet.*?ReadSchema: (\S+)", plan(store.remaining(listed)), re.S).group(1)
        # The one exchange is of the listing: it has as many partitions as the store has buckets.
        assert re.search(r"hashpartitioning\(catalog_name#\d+, schema_name#\d+, object_name#\d+, 5\)", plan(store.remaining(listed)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
