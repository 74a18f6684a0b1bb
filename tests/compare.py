"""Comparison of a Spark result with that of the checking SQL."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _value(value):
    return "null" if value is None or (isinstance(value, float) and math.isnan(value)) else repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def difference(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both have the same columns and the same rows, as often, in any order."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} are not {sorted(names)}"
    wanted = _rows(names, cursor.fetchall())
    found = _rows(result.columns, result.collect())
    if wanted == found:
        return ""
    extra, missing = found - wanted, wanted - found
    return (f"{sum(found.values())} rows against {sum(wanted.values())}; not expected: {list(extra.items())[:2]}; "
            f"missing: {list(missing.items())[:2]}")
