"""Functions over `CREATE` statement texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ddlscope.fixed import HIVE_CATALOGS
from ddlscope.functions.text import as_column, label

# A quoted literal. The possessive groups keep Java from recursing once per character on long literals.
_LITERAL = r"""'(?:[^'\\]++|\\[^\n])*+'|"(?:[^"\\]++|\\[^\n])*+\""""
# A quote inside backticks that does not open a literal; one that does ends the identifier.
_STRAY_QUOTE = rf"""(?!{_LITERAL})['"]"""
_SPACE = r"[\s\x1c-\x1f]*+"
_DOT = rf"{_SPACE}\.{_SPACE}"
_IDENTIFIER = rf"(?:`(?:[^`'\"]++|``|{_STRAY_QUOTE})++`|[A-Za-z_][\w$]*+)"
_IDENTIFIER_START = rf"(?:`(?:[^`'\"]|``|{_STRAY_QUOTE})(?:[^`'\"]++|{_STRAY_QUOTE})*+`|[A-Za-z_])"
_PLAIN_NAME = r"(?U)\A[A-Za-z_][\w$]*\z"

# White space, and the first six words of a statement with what is between them.
_GAP = r"[\s\x1c-\x1f]"
_SIX_WORDS = rf"(?U)\A{_GAP}*+((?:[\S&&[^\x1c-\x1f]]++{_GAP}*+){{0,6}})"


def kind_from_table_type(table_type: str | Column) -> Column:
    """Kind of an object whose listing carries a table type."""
    upper = F.upper(F.coalesce(as_column(table_type), F.lit("")))
    return (F.when(upper == "VIEW", "VIEW").when(upper == "STREAMING_TABLE", "STREAMING TABLE")
            .when(upper == "MATERIALIZED_VIEW", "MATERIALIZED VIEW").otherwise("TABLE"))


# What the words after CREATE say, whatever the object is called.
_STRICT = (r"\ACREATE (?:OR (?:REPLACE|REFRESH) )?(?:(?:GLOBAL|TEMP|TEMPORARY|EXTERNAL) )*+(MATERIALIZED VIEW|STREAMING TABLE|VIEW|TABLE)\b")


def kind_from_ddl(ddl: str | Column, strict: bool = False) -> Column:
    """Kind named in the first six words of the statement, null when none is. Only the head of the text is read.
    A name such as `customer_view` within these words counts as well, unless `strict`: then the words after CREATE decide."""
    if strict:
        words = F.regexp_replace(F.upper(F.regexp_extract(as_column(ddl), _SIX_WORDS, 1)), f"(?U){_GAP}++", " ")
        return F.nullif(F.regexp_extract(words, _STRICT, 1), F.lit(""))
    head = F.upper(F.regexp_extract(as_column(ddl), _SIX_WORDS, 1))

    def two_words(text: Column, first: str, second: str) -> Column:
        return text.contains(first) & text.rlike(f"(?U){first}{_GAP}++{second}")

    def first_kind(text: Column) -> Column:
        return (F.when(two_words(text, "MATERIALIZED", "VIEW"), "MATERIALIZED VIEW")
                .when(two_words(text, "STREAMING", "TABLE"), "STREAMING TABLE")
                .when(text.contains("VIEW"), "VIEW").when(text.contains("TABLE"), "TABLE"))

    # As an array of one, the head is computed once and not again for each kind.
    return F.transform(F.array(head), first_kind)[0]


def _escaped(name: Column, unless: str = rf"(?!{_LITERAL})") -> Column:
    """The name as a regex that matches it literally, where a quote must not open a literal. This runs for each row
    when the catalog is a column, so names without quotes need no regex to be escaped."""
    escaped = F.replace(name, F.lit(r"\E"), F.lit(r"\E\\E\Q"))
    before_quote = r"\\E" + unless.replace("\\", "\\\\")
    guarded = F.regexp_replace(escaped, "(['\"])", rf"{before_quote}$1\\Q")
    has_quote = name.contains("'") | name.contains('"')
    return F.concat(F.lit(r"\Q"), F.when(has_quote, guarded).otherwise(escaped), F.lit(r"\E"))


def _spellings(name: Column) -> Column:
    """Alternatives that denote the catalog: always in backticks, and bare where the name allows it."""
    in_backticks = F.concat(F.lit("`"), _escaped(F.replace(name, F.lit("`"), F.lit("``"))), F.lit("`"))
    bare = F.when(name.rlike(_PLAIN_NAME), F.concat(F.lit("|"), _escaped(name))).otherwise("")
    return F.concat(in_backticks, bare)


def catalog_prefix_pattern(catalog: Column) -> Column:
    """Regex of one pass over a text: a literal (kept as group 1), or the catalog in front of `schema.object`.
    It starts with the characters either can begin with, so that most of a text is passed over cheaply.
    For a constant catalog the whole pattern folds to a constant and is compiled once."""
    is_hive = F.lower(catalog).isin(*HIVE_CATALOGS)
    hive_names = "".join(f"|`{name}`|{name}" for name in HIVE_CATALOGS)
    hive_starts = "".join(name[0] for name in HIVE_CATALOGS)
    return F.concat(
        F.lit("(?iU)(?=['\"`"), _escaped(F.substring(catalog, 1, 1), ""), F.when(is_hive, hive_starts).otherwise(""),
        F.lit(rf"])(?:({_LITERAL})|(?<![\w`.$])(?:"),
        _spellings(catalog), F.when(is_hive, hive_names).otherwise(""),
        F.lit(rf"){_DOT}(?={_IDENTIFIER}{_DOT}{_IDENTIFIER_START}))"))


def discard_catalog(ddl: str | Column, catalog: str | Column) -> Column:
    """`catalog.schema.object` becomes `schema.object` everywhere but inside literals. Names of other catalogs and
    two-part names stay. `catalog` is a column, or a constant through `F.lit`."""
    return F.regexp_replace(as_column(ddl), catalog_prefix_pattern(as_column(catalog)), F.lit("$1"))


def export_chunk(keep_catalog: bool = False, catalog: str | Column = "catalog_name",
                 schema: str | Column = "schema_name", name: str | Column = "object_name",
                 ddl: str | Column = "ddl") -> Column:
    """Comment header and statement of one object, as they stand in the exported text."""
    catalog, ddl = as_column(catalog), as_column(ddl)
    header = label(schema, name)
    if keep_catalog:
        header = F.concat(catalog, F.lit("."), header)
    else:
        ddl = discard_catalog(ddl, catalog)
    return F.concat(F.lit("-- "), header, F.lit("\n"), ddl, F.lit(";\n"))
