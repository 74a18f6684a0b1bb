"""Functions over error texts and attempts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from ddlscope.fixed import JITTER, MAX_DELAY_SECONDS, PERMISSION_MARKERS, RETRIES, TRANSIENT_MARKERS, UNSUPPORTED_KINDS
from ddlscope.functions.text import LINE_ENDS, as_column, trimmed


def short_error(message: str | Column) -> Column:
    """Error text in front of the JVM stack trace, trimmed."""
    return trimmed(F.substring_index(as_column(message), "JVM stacktrace", 1))


def first_line(message: str | Column) -> Column:
    """First line of the short error. It is blank only when the whole text is, since the text is trimmed."""
    return trimmed(F.regexp_extract(short_error(message), rf"\A[^{LINE_ENDS}]*+", 0))


def error_line(error_type: str | Column, message: str | Column) -> Column:
    """`Type: first line`, or `Type: (no message)`."""
    line = F.coalesce(F.nullif(first_line(message), F.lit("")), F.lit("(no message)"))
    return F.concat(as_column(error_type), F.lit(": "), line)


def _has_any(reason: str | Column, markers: tuple[str, ...]) -> Column:
    text = F.coalesce(as_column(reason), F.lit(""))
    return reduce(Column.__or__, (text.contains(marker) for marker in markers))


def is_permission_error(reason: str | Column = "reason") -> Column:
    return _has_any(reason, PERMISSION_MARKERS)


def is_transient(reason: str | Column = "reason") -> Column:
    """Worth a retry: throttled or unavailable, and not a permission error."""
    return _has_any(reason, TRANSIENT_MARKERS) & ~is_permission_error(reason)


def is_retried(reason: str | Column = "reason", attempt: str | Column = "attempt") -> Column:
    """Whether the policy makes another attempt after this one; attempts count from 0."""
    return is_transient(reason) & (as_column(attempt) < RETRIES)


def is_final(reason: str | Column = "reason", attempt: str | Column = "attempt") -> Column:
    """Whether the policy makes no attempt after this one: it went well, or failed for good, or was the last."""
    return ~is_retried(reason, attempt)


def retry_delay(bound: str, reason: str | Column = "reason", attempt: str | Column = "attempt") -> Column:
    """Shortest (`min`) or longest (`max`) wait in seconds before the next attempt, null without one."""
    factor = JITTER[0] if bound == "min" else JITTER[1]
    backoff = F.least(F.pow(F.lit(2.0), as_column(attempt)), F.lit(float(MAX_DELAY_SECONDS)))
    return F.when(is_retried(reason, attempt), backoff * factor)


def outcome(reason: str | Column = "reason", kind: str | Column = "kind") -> Column:
    """What became of one object: generated, excluded, cancelled or failed."""
    reason, kind = as_column(reason), as_column(kind)
    return (F.when(reason.isNull() & F.coalesce(kind.isin(*UNSUPPORTED_KINDS), F.lit(False)), "excluded")
            .when(reason.isNull(), "generated").when(reason == "cancelled", "cancelled").otherwise("failed"))
