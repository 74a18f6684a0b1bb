"""Size of an export, measured without building it as one text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ddlscope.functions.ddl import export_chunk
from ddlscope.functions.sizes import json_bytes
from ddlscope.functions.text import listing_order
from ddlscope.schemas import KEYS


def with_chunk(objects: DataFrame, keep_catalog: bool = False) -> DataFrame:
    """Add the exported text of each object."""
    return objects.withColumn("chunk", export_chunk(keep_catalog))


def payload_sizes(chunks: DataFrame, by: Sequence[str] = ("catalog_name",), envelope_bytes: int = 0) -> DataFrame:
    """Objects, bytes of the joined text, and bytes of a JSON body with it. Chunks are joined by a line feed, which is
    one byte of text and two in JSON. Sizes add up, so tasks send partial sums; a size that is not used is not
    computed."""
    joints = F.count("*") - 1
    return chunks.groupBy(*by).agg(
        F.count("*").alias("objects"),
        (F.sum(F.octet_length("chunk").cast("bigint")) + joints).alias("raw_bytes"),
        (F.sum(json_bytes("chunk")) + joints * 2 + envelope_bytes).alias("body_bytes"))


def preview(objects: DataFrame, ddl: DataFrame, rows: int, keep_catalog: bool = False,
            lead: Sequence[str] = ()) -> DataFrame:
    """The exported texts of the first objects of each export, that is of a catalog, numbered in listing order. Only keys go
    through the top-k, and tasks send at most `rows` of a catalog. The texts are then taken out of `ddl`, one row per object,
    by a join with the few keys found; as long as these stay small when measured, no text is shuffled."""
    keys = [*lead, *KEYS]
    in_catalog = Window.partitionBy(*lead, "catalog_name").orderBy(*listing_order())
    numbered = objects.select(*keys).withColumn("position", F.row_number().over(in_catalog)).where(F.col("position") <= rows)
    found = ddl.select(*keys, "ddl").join(numbered, keys)
    return with_chunk(found, keep_catalog).select("position", *keys, "chunk")


def preview_counts(objects: DataFrame, rows: int, by: Sequence[str] = ("catalog_name",)) -> DataFrame:
    """How many objects a preview of each export shows, and of how many."""
    return (objects.groupBy(*by).agg(F.count("*").alias("objects"))
            .withColumn("shown", F.least(F.col("objects"), F.lit(rows))))
