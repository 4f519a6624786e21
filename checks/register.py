"""Registry of checked queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(sql: str | None = None, name: str | None = None):
    """Register a query under its function's name, with its SQL if it has one."""
    def add(query: Query) -> Query:
        key = name or query.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = query
        if sql is not None:
            ORACLES[key] = sql
        return query
    return add
