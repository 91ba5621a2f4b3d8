"""The query set: a name, a Spark query over the shared tables, and its check SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query. ``sql`` is left out where no SQL can give the same result."""

    def add(run):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(run, sql)
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A shared table, read as it is."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
