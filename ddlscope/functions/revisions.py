"""Functions over revision records."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ddlscope.functions.text import as_column, trimmed


def given(number: str) -> Column:
    """The field's text and value, null where it is missing, empty or the number 0."""
    text, value = F.col(number), F.col(f"{number}_value")
    return F.when((text != "") & ~F.coalesce(value == 0, F.lit(False)), F.struct(text.alias("text"), value.alias("value")))


def stated(number: str) -> Column:
    """The field's text and value as they stand, null where it is missing."""
    return F.when(F.col(number).isNotNull(), F.struct(F.col(number).alias("text"), F.col(f"{number}_value").alias("value")))


def either_text(*texts: str | Column) -> Column:
    """The first text that is neither missing nor empty, else empty."""
    return F.coalesce(*(F.nullif(as_column(t), F.lit("")) for t in texts), F.lit(""))


def revision_label(number: str | Column, name: str | Column) -> Column:
    return trimmed(F.concat(F.lit("From revision "), as_column(number).cast("string"), F.lit(": "), as_column(name)))


def number_rank(number: str | Column) -> Column:
    """Sort value of a revision number: itself when it is a whole number, else 0."""
    text = as_column(number).cast("string")
    return F.coalesce(F.when(text.rlike(r"\A-?[0-9]+\z"), text.try_cast("bigint")), F.lit(0).cast("bigint"))
