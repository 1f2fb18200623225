"""Runnable examples of every operator on the test tables, with equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where one exists, the SQL that gives the same rows."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def load_all() -> None:
    from . import (  # noqa: F401
        aggregations,
        flagship,
        hooks,
        joins,
        projections,
        runlogs,
        scalars,
        sinks,
        sources,
        updates,
        windows,
    )
