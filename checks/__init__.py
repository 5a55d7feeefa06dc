"""Queries over the TPC-H-like test tables, each with the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str) -> Callable[[Query], Query]:
    """Register a query under a name with its equivalent SQL."""

    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = query
        SQL[name] = sql
        return query

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_all() -> None:
    """Import the modules that register queries."""
    from checks import calls, rows, staff, tabs  # noqa: F401
