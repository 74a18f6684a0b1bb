"""DDL functions on texts written by hand, and on random ones against a scanner."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ddlscope.functions.ddl import discard_catalog, export_chunk, kind_from_ddl, kind_from_table_type


def discarded(spark, pairs):
    rows = [(i, ddl, catalog) for i, (ddl, catalog) in enumerate(pairs)]
    found = spark.createDataFrame(rows, "i int, ddl string, catalog string")
    return [r.out for r in found.select("i", discard_catalog("ddl", "catalog").alias("out")).orderBy("i").collect()]


LONG = "a" * 200_000

GOLDEN = [
    # text, catalog, wanted
    ("CREATE TABLE `main`.`s`.`t` (x INT)", "main", "CREATE TABLE `s`.`t` (x INT)"),
    ("FROM Main . s . u JOIN MAIN.s.v", "main", "FROM s . u JOIN s.v"),
    ("COMMENT 'main.s.t' \"main.s.t\" main.s.t", "main", "COMMENT 'main.s.t' \"main.s.t\" s.t"),
    ("other.s.t, main2.s.t, xmain.s.t", "main", "other.s.t, main2.s.t, xmain.s.t"),
    ("SELECT main.t", "main", "SELECT main.t"),
    ("SELECT main.s.f(x), main.s.t.c", "main", "SELECT s.f(x), s.t.c"),
    ("a.main.s.t `main.s.t $main.s.t émain.s.t", "main", "a.main.s.t `main.s.t $main.s.t émain.s.t"),
    ("main.main.s.t", "main", "main.s.t"),
    # A literal directly in front of the name, and an apostrophe in a comment that opens one.
    ("'x'main.s.t", "main", "'x's.t"),
    ("-- it's\nmain.s.t -- isn't\nmain.s.t", "main", "-- it's\nmain.s.t -- isn't\ns.t"),
    (r"'it\'s main.s.t' main.s.t", "main", r"'it\'s main.s.t' s.t"),
    # A quote within backticks opens a literal only if it is closed somewhere.
    ("main.`o'brien`.t", "main", "`o'brien`.t"),
    ("main.`o'brien`.t = 'z'", "main", "main.`o'brien`.t = 'z'"),
    ("`a'b`.s.t", "a'b", "s.t"),
    ("`a'b`.s.t = 'z'", "a'b", "`a'b`.s.t = 'z'"),
    ("`a\"'b`.s.t", "a\"'b", "s.t"),
    ("`a\"'b`.s.t \"", "a\"'b", "`a\"'b`.s.t \""),
    ("`\\E'`.s.t `x\\`.s.t", "\\E'", "s.t `x\\`.s.t"),
    ("`x\\`.s.t", "x\\", "s.t"),
    ("`'`.s.t", "'", "s.t"),
    # Names that need backticks, and characters that mean something in a regex.
    ("`x``y`.s.t", "x`y", "s.t"),
    ("ext-sales.s.t `ext-sales`.s.t", "ext-sales", "ext-sales.s.t s.t"),
    ("`a\\Eb`.s.t `a.b`.s.t", "a\\Eb", "s.t `a.b`.s.t"),
    ("`a.b`.s.t `axb`.s.t", "a.b", "s.t `axb`.s.t"),
    ("café.s.t CAFÉ.s.t `café`.s.t", "café", "s.t s.t s.t"),
    # Either Hive name stands for the other, and for nothing else.
    ("hive_metastore.a.b `spark_catalog`.a.b", "spark_catalog", "a.b a.b"),
    ("hive_metastore.a.b Spark_Catalog.a.b", "HIVE_METASTORE", "a.b a.b"),
    ("hive_metastore.a.b", "main", "hive_metastore.a.b"),
    # Long literals, closed and not, and long backticked names.
    (f"'{LONG}' main.s.t", "main", f"'{LONG}' s.t"),
    (f"'{LONG} main.s.t", "main", f"'{LONG} s.t"),
    ("'" + "\\x" * 100_000 + "' main.s.t", "main", "'" + "\\x" * 100_000 + "' s.t"),
    ("main.`" + "``" * 100_000 + "`.t", "main", "`" + "``" * 100_000 + "`.t"),
    ("", "main", ""),
    (None, "main", None),
]


def test_discard_catalog_golden(spark):
    for (ddl, catalog, wanted), found in zip(GOLDEN, discarded(spark, [g[:2] for g in GOLDEN])):
        assert found == wanted, (ddl and ddl[:80], catalog)


def test_constant_catalog_gives_the_same(spark):
    rows = [(ddl,) for ddl, catalog, _ in GOLDEN if catalog == "main"]
    found = spark.createDataFrame(rows, "ddl string").select(discard_catalog("ddl", F.lit("main")).alias("out"))
    assert [r.out for r in found.collect()] == [wanted for _, catalog, wanted in GOLDEN if catalog == "main"]


def _literals_and_rest(text):
    """Pieces of the text with whether each is a closed literal."""
    pieces, start, i = [], 0, 0
    while i < len(text):
        end = None
        if text[i] in "'\"":
            j = i + 1
            while j < len(text) and end is None:
                if text[j] == "\\":
                    if j + 1 == len(text) or text[j + 1] == "\n":
                        break
                    j += 2
                elif text[j] == text[i]:
                    end = j + 1
                else:
                    j += 1
        if end:
            pieces += [(text[start:i], False), (text[i:end], True)]
            start = i = end
        else:
            i += 1
    return [*pieces, (text[start:], False)]


def _after_dot(piece, i):
    while i < len(piece) and piece[i].isspace():
        i += 1
    if i == len(piece) or piece[i] != ".":
        return None
    i += 1
    while i < len(piece) and piece[i].isspace():
        i += 1
    return i


def _starts_name(character):
    return character == "_" or (character.isascii() and character.isalpha())


def _after_name(piece, i):
    """Where a whole identifier that starts at i ends."""
    if i < len(piece) and piece[i] == "`":
        j = i + 1
        while j < len(piece):
            if piece[j] != "`":
                j += 1
            elif piece[j:j + 2] == "``":
                j += 2
            else:
                return j + 1 if j > i + 1 else None
        return None
    if i < len(piece) and _starts_name(piece[i]):
        while i < len(piece) and (piece[i].isalnum() or piece[i] in "_$"):
            i += 1
        return i
    return None


def _has_name(piece, i):
    """Whether some identifier can be read at i; within backticks it may end at any of them."""
    if i < len(piece) and piece[i] == "`":
        inner = piece[i + 1:]
        skip = 2 if inner.startswith("``") else 1 if inner and inner[0] != "`" else None
        return skip is not None and "`" in inner[skip:]
    return i < len(piece) and _starts_name(piece[i])


def scanned(text, names):
    """What should come out, by reading the text character by character."""
    out = []
    for piece, is_literal in _literals_and_rest(text):
        i = 0
        while i < len(piece):
            end = None
            if not is_literal and (i == 0 or not (piece[i - 1].isalnum() or piece[i - 1] in "_`.$")):
                for spelling in names:
                    if end is None and piece[i:i + len(spelling)].lower() == spelling:
                        schema = _after_dot(piece, i + len(spelling))
                        name = _after_name(piece, schema) if schema is not None else None
                        after = _after_dot(piece, name) if name is not None else None
                        end = schema if after is not None and _has_name(piece, after) else None
            if end is None:
                out.append(piece[i])
                i += 1
            else:
                i = end
    return "".join(out)


_TOKENS = st.sampled_from(["main", "MAIN", "`main`", "s", "t1", ".", ".", ".", " ", "\n", "'", '"', "`", "``", "\\", "$", "é", ",",
                           "main.s.t", "`main`.`s`.`t`", "'x'", "--"])


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(st.lists(_TOKENS, max_size=25).map("".join), min_size=150, max_size=150))
def test_discard_catalog_equals_a_scanner(spark, texts):
    for text, found in zip(texts, discarded(spark, [(t, "main") for t in texts])):
        assert found == scanned(text, ["`main`", "main"]), text


@settings(max_examples=5, deadline=None)
@given(texts=st.lists(st.lists(_TOKENS, max_size=25).map("".join), min_size=100, max_size=100))
def test_discard_catalog_is_the_identity_without_the_catalog(spark, texts):
    assert discarded(spark, [(t, "elsewhere") for t in texts]) == texts


def test_discard_catalog_twice_changes_nothing_more(spark):
    texts = [g[0] for g in GOLDEN[:10] if "main.main" not in g[0]]
    once = discarded(spark, [(t, "main") for t in texts])
    assert discarded(spark, [(t, "main") for t in once]) == once


@pytest.mark.parametrize("ddl, wanted", [
    ("CREATE TABLE a.b.c (x INT)", "TABLE"),
    ("create\n materialized\t view a.b.c", "MATERIALIZED VIEW"),
    ("CREATE OR REFRESH STREAMING TABLE a.b.c", "STREAMING TABLE"),
    ("CREATE OR REPLACE VIEW a.b.c AS SELECT 1", "VIEW"),
    # The name of a table is among the first six words and counts.
    ("CREATE TABLE a.b.customer_view (x INT)", "VIEW"),
    ("  \x1f\x85CREATE\x1cTABLE　x", "TABLE"),
    ("one two three four five six TABLE", None),
    ("", None),
    (None, None),
])
def test_kind_from_ddl(spark, ddl, wanted):
    assert spark.createDataFrame([(ddl,)], "d string").select(kind_from_ddl("d")).first()[0] == wanted


def test_kind_from_table_type(spark):
    rows = spark.createDataFrame([("view",), ("STREAMING_TABLE",), ("MATERIALIZED_VIEW",), ("EXTERNAL",), ("",), (None,)], "t string")
    assert [r[0] for r in rows.select(kind_from_table_type("t")).collect()] == [
        "VIEW", "STREAMING TABLE", "MATERIALIZED VIEW", "TABLE", "TABLE", "TABLE"]


def test_export_chunk(spark):
    row = spark.createDataFrame([("main", "s", "t", "CREATE TABLE main.s.t")],
                                "catalog_name string, schema_name string, object_name string, ddl string")
    assert row.select(export_chunk()).first()[0] == "-- s.t\nCREATE TABLE s.t;\n"
    assert row.select(export_chunk(keep_catalog=True)).first()[0] == "-- main.s.t\nCREATE TABLE main.s.t;\n"


def test_strict_kind_goes_by_the_words_after_create(spark):
    texts = ["CREATE TABLE c.s.customer_view", "create  or\trefresh streaming\ntable x", "CREATE OR REPLACE GLOBAL TEMPORARY VIEW v", "CREATE MATERIALIZED VIEW m",
             "CREATE EXTERNAL TABLE t", "SELECT * FROM table", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    assert [r[0] for r in rows.select(kind_from_ddl("v", strict=True)).collect()] == [
        "TABLE", "STREAMING TABLE", "VIEW", "MATERIALIZED VIEW", "TABLE", None, None, None]
