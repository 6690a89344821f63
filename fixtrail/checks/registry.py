"""Where queries and their oracles are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .testbed import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name with the SQL that must give the same rows."""
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return query

    return keep
