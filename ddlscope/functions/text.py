"""Names, labels and text predicates."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

# Every character that counts as white space when text is trimmed or split into words.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000")
# Every character that ends a line.
LINE_ENDS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trimmed(text: str | Column) -> Column:
    """Text without white space at both ends; plain `trim` removes spaces only."""
    return F.btrim(as_column(text), F.lit(WHITESPACE))


def normalized(name: str | Column) -> Column:
    """The form in which names are compared: trimmed and lower-cased."""
    return F.lower(trimmed(name))


def like_pattern(pattern: str | None) -> str | None:
    """Java regex of a name filter: `*` is any text on one line, `|` separates alternatives whose outer white space does
    not count, all else is literal. None when the filter is blank and so keeps everything."""
    if not pattern or pattern.isspace():
        return None
    literal = re.sub(r"[^*|]+", lambda run: re.escape(run.group()), re.sub(r"\s*\|\s*", "|", pattern.strip()))
    return rf"(?iu)\A(?:{literal.replace('*', '[^\n]*')})\z"


def like_matches(name: str | Column, pattern: str | None) -> Column:
    """Whether the whole name matches the filter, in any case."""
    regex = like_pattern(pattern)
    return F.lit(True) if regex is None else as_column(name).rlike(regex)


def folded(name: str | Column) -> Column:
    """The name in a form in which names that a filter takes for equal begin alike, as far as these are ASCII letters: other
    letters that count as one of these in any case (of i, k and s) become that one."""
    return F.lower(F.translate(as_column(name), "\u017f\u212a\u0130\u0131", "skii"))


def like_prefixes(pattern: str | None) -> list[str] | None:
    """What the folded names that match a filter begin with, one text for each alternative and no longer than it is plain
    ASCII; None when that leaves out nothing, since an alternative begins with anything."""
    if like_pattern(pattern) is None:
        return None
    literals = [re.match(r"[^*]*", part.strip()).group() for part in pattern.strip().split("|")]
    prefixes = [re.match(r"[\x00-\x7f]*", text).group().lower() for text in literals]
    shortest = sorted({p for p in prefixes if not any(p != q and p.startswith(q) for q in prefixes)})
    return None if "" in shortest else shortest


def begins_as(folded_name: str | Column, pattern: str | None) -> Column:
    """Whether the folded name begins as the filter asks: necessary for a match, and for a file reader to skip by."""
    prefixes = like_prefixes(pattern)
    if prefixes is None:
        return F.lit(True)
    return reduce(Column.__or__, (as_column(folded_name).startswith(p) for p in prefixes))


def search_matches(query: str | None, schema: str = "schema_name", name: str = "object_name",
                   kind: str = "kind") -> Column:
    """Whether `schema.name kind` contains the searched text, in any case; a blank text matches all."""
    wanted = (query or "").strip().lower()
    if not wanted:
        return F.lit(True)
    return F.lower(F.concat(label(schema, name), F.lit(" "), kind_or_table(kind))).contains(wanted)


def label(schema: str | Column = "schema_name", name: str | Column = "object_name") -> Column:
    """`schema.name`, for display only. Joins use the key columns, because names may hold dots."""
    return F.concat(as_column(schema), F.lit("."), as_column(name))


def kind_or_table(kind: str | Column = "kind") -> Column:
    return F.coalesce(F.nullif(as_column(kind), F.lit("")), F.lit("TABLE"))


def quoted(name: str | Column) -> Column:
    """An identifier in backticks, inner backticks doubled."""
    return F.concat(F.lit("`"), F.replace(as_column(name), F.lit("`"), F.lit("``")), F.lit("`"))


def listing_order(schema_keys: tuple[str, ...] = ("catalog_name", "schema_name"),
                  name: str = "object_name") -> list[Column]:
    """Sort keys of every listing. The last key makes names that differ only in case deterministic."""
    return [F.col(k) for k in schema_keys] + [F.lower(F.col(name)), F.col(name)]
