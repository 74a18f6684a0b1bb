"""Connected components of a table of links, by union-find inside the tasks and rounds of hooking between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ddlscope.session import scratch_path

SCHEMA = "node long, root long"


def saved(rows: DataFrame, label: str) -> DataFrame:
    """The rows as a written table in the shared folder: cut off from their lineage, safe from lost executors."""
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one task: each node but a root with the least node it is joined to."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while (up := parent.get(x, x)) != root and x != root:
            parent[x], x = root, up
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = np.fromiter(parent, np.int64, len(parent))
    roots = np.fromiter((find(x) for x in list(parent)), np.int64, len(parent))
    if len(nodes):
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], names=["node", "root"])


def components(links: DataFrame) -> DataFrame:
    """node and root for every node that is not the least of its component; `links` has two columns of long.

    Each round replaces links by those to the least neighbour, which keeps what is connected and halves the paths, so the
    rounds grow with the logarithm of the longest path. A node with very many links costs no more: the least neighbour is an
    aggregate, and joins on it are split by adaptive execution. Ends when no root is itself joined to a smaller one."""
    edges = saved(links.toDF("node", "root").mapInArrow(forest, SCHEMA), "forest")
    while True:
        inner = edges.select(F.col("root").alias("node")).join(edges.select("node"), "node", "left_semi")
        several = edges.groupBy("node").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
        if inner.isEmpty() and several.isEmpty():
            return edges.distinct()
        both = edges.union(edges.select("root", "node")).toDF("node", "other")
        least = both.groupBy("node").agg(F.least("node", F.min("other")).alias("root"))
        moved = both.join(least, "node").select(F.col("other").alias("node"), "root").union(least.select("node", "root"))
        edges = saved(moved.filter("node <> root").distinct().mapInArrow(forest, SCHEMA), "forest")
