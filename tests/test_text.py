"""Text, error and size functions."""

import json

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ddlscope.functions import errors, revisions, sizes, text


def column(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in rows.select("i", expression.alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize("pattern, matching, other", [
    (None, ["x", ""], []), ("  ", ["x"], []),
    ("fact_*|dim_*", ["fact_a", "DIM_b", "fact_"], ["a_fact_", "fact"]),
    (" fact.* | *_2024 \t", ["FACT.x", "t_2024"], ["factxa", "t_2024 "]),
    ("a|", ["a", ""], ["b"]), ("*", ["", "anything"], ["two\nlines"]),
    ("é*", ["Éa"], ["ea"]), ("a[b]+(c)", ["A[B]+(C)"], ["abc"]), ("abc", ["ABC"], ["abc\n"]),
])
def test_like(spark, pattern, matching, other):
    assert column(spark, matching + other, text.like_matches("v", pattern)) == [True] * len(matching) + [False] * len(other)


def test_search_covers_the_kind_and_spans_name_and_kind(spark):
    rows = spark.createDataFrame([("s", "orders", None), ("s", "Orders_2", "VIEW"), ("s", "x", "")],
                                 "schema_name string, object_name string, kind string")

    def found(query):
        return [r.object_name for r in rows.where(text.search_matches(query)).collect()]
    assert found("orders tab") == ["orders"] and found(" TABLE ") == ["orders", "x"]
    assert found("s.orders") == ["orders", "Orders_2"] and len(found("  ")) == 3 and found(None) == found("")


def test_trimming_covers_all_white_space(spark):
    assert column(spark, ["\t\x1c a b　\x85 ", "\n"], text.trimmed("v")) == ["a b", ""]
    assert column(spark, ["\t ÀB "], text.normalized("v")) == ["àb"]


def test_quoting(spark):
    assert column(spark, ["a`b", "x"], text.quoted("v")) == ["`a``b`", "`x`"]


def test_errors(spark):
    messages = ["x\n\n y JVM stacktrace: z JVM stacktrace", "\n\n", "JVM stacktrace", " a\r\nb ", "a b", "plain", None]
    assert column(spark, messages, errors.short_error("v")) == ["x\n\n y", "", "", "a\r\nb", "a b", "plain", None]
    assert column(spark, messages, errors.error_line(F.lit("E"), "v"))[:6] == [
        "E: x", "E: (no message)", "E: (no message)", "E: a", "E: a", "E: plain"]


def test_transient_and_permission(spark):
    reasons = ["HTTP 503", "table t_429 is missing", "request_limit_exceeded", "PERMISSION_DENIED after 503", "timeout", None]
    assert column(spark, reasons, errors.is_transient("v")) == [True, True, False, False, False, False]
    assert column(spark, reasons, errors.is_permission_error("v")) == [False, False, False, True, False, False]


def test_retry_policy(spark):
    attempts = spark.range(6).select(F.col("id").cast("int").alias("attempt"), F.lit("HTTP 503").alias("reason"))
    rows = attempts.select(errors.is_retried().alias("again"), errors.retry_delay("min").alias("lo"),
                           errors.retry_delay("max").alias("hi")).collect()
    assert [tuple(r) for r in rows] == [(True, 0.75, 1.25), (True, 1.5, 2.5), (True, 3.0, 5.0), (True, 6.0, 10.0),
                                        (False, None, None), (False, None, None)]


def test_outcome(spark):
    rows = spark.createDataFrame([(None, "TABLE"), (None, "STREAMING TABLE"), (None, None), ("cancelled", "VIEW"),
                                  ("boom", "STREAMING TABLE")], "reason string, kind string")
    assert [r[0] for r in rows.select(errors.outcome()).collect()] == [
        "generated", "excluded", "generated", "cancelled", "failed"]


@settings(max_examples=8, deadline=None)
@given(texts=st.lists(st.text(max_size=60), min_size=150, max_size=150))
def test_json_bytes_equal_the_encoder(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    texts += [chr(c) for c in [*range(0x300), 0x2028, 0x2029, 0xfeff, 0xfffd]]
    texts += ['"\\\n\r\t\x08\x0c\x00\x1f\x7f\x80é€￿\U00010000\U0010ffff', "", "a" * 300_000 + "é"]
    assert column(spark, texts, sizes.json_bytes("v")) == [len(json.dumps(t)) - 2 for t in texts]


def test_size_verdict(spark):
    rows = spark.createDataFrame([(10, 5), (11, 5), (10, 6), (11, 6), (10, None)], "raw long, wire long")
    verdict = sizes.size_verdict("raw", "wire", raw_limit=10, wire_limit=5)
    assert [r[0] for r in rows.select(verdict).collect()] == ["ok", "uncompressed", "compressed", "uncompressed", "unknown"]
    missing = spark.createDataFrame([(None, None), (5, None), (20, None), (None, 1), (None, 9)], "raw long, wire long")
    assert [r[0] for r in missing.select(verdict).collect()] == ["unknown", "unknown", "uncompressed", "unknown", "compressed"]


def test_revision_functions(spark):
    rows = spark.createDataFrame([("7", 7, "n", "m"), ("0", 0, "", "m"), ("0", None, None, None), ("", None, "a", ""), (None, None, "", "")],
                                 "a string, a_value long, e string, f string")
    found = rows.select(revisions.given("a")["text"], revisions.stated("a")["text"], revisions.either_text("e", "f")).collect()
    assert [tuple(r) for r in found] == [("7", "7", "n"), (None, "0", "m"), ("0", "0", ""), (None, "", "a"), (None, None, "")]
    assert column(spark, ["12", "-3", "v2", "1.5", None, "9" * 30], revisions.number_rank("v")) == [12, -3, 0, 0, 0, 0]
    assert column(spark, ["", "two"], revisions.revision_label(F.lit(5), "v")) == ["From revision 5:", "From revision 5: two"]
