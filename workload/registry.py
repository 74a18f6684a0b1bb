"""The registered queries: each a Spark job over whole given tables, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from workload.fixtures import fixture, given, with_fixtures


@dataclass(frozen=True)
class Tables:
    """Fixtures and given tables of one scale, by name."""

    spark: SparkSession
    folder: str

    def __call__(self, name: str) -> DataFrame:
        return (fixture if name.startswith("fx_") else given)(self.spark, self.folder, name)


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a query under its function's name, with the SQL of the same result if there is one."""
    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if build.__name__ in QUERIES:
            raise ValueError(f"query {build.__name__} is registered twice")
        QUERIES[build.__name__] = Query(build, with_fixtures(sql) if sql else None)
        return build
    return register
