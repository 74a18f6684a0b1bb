"""Sizes of texts and verdicts on them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ddlscope.fixed import RAW_LIMIT_BYTES, WIRE_LIMIT_BYTES
from ddlscope.functions.text import as_column

def json_bytes(text: str | Column) -> Column:
    """Bytes of the text inside an ASCII-escaped JSON string, without the two quotes.

    The JSON writer escapes quotes, backslashes and control characters, one byte for each character it then has. What it
    leaves and ASCII-escaped JSON does not, takes six bytes: the delete character and all beyond ASCII, or twelve above
    U+FFFF. Texts are searched for the latter only when they have more bytes than characters."""
    text = as_column(text)
    around = len('{"t":""}')
    written = F.length(F.to_json(F.struct(text.alias("t")))) - around
    deletes = F.length(text) - F.length(F.replace(text, F.lit("\x7f"), F.lit("")))
    beyond_ascii = F.length(F.regexp_replace(text, r"[\x00-\x7f]++", ""))
    beyond_plane = F.length(F.regexp_replace(text, r"[\x00-\x{ffff}]++", ""))
    longer = F.when(F.octet_length(text) == F.length(text), 0).otherwise(5 * beyond_ascii + 6 * beyond_plane)
    return F.when(text.isNotNull(), (written + 5 * deletes + longer).cast("bigint"))


def size_verdict(raw_bytes: str | Column, wire_bytes: str | Column | None = None,
                 raw_limit: int = RAW_LIMIT_BYTES, wire_limit: int = WIRE_LIMIT_BYTES) -> Column:
    """`ok`, or the limit that is broken; the uncompressed size is looked at first. Without a size it is `unknown`."""
    verdict = F.when(as_column(raw_bytes) > raw_limit, "uncompressed")
    known = as_column(raw_bytes).isNotNull()
    if wire_bytes is not None:
        verdict = verdict.when(as_column(wire_bytes) > wire_limit, "compressed")
        known = known & as_column(wire_bytes).isNotNull()
    return verdict.when(known, "ok").otherwise("unknown")
