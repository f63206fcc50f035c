"""The queries of this subpackage and, where SQL can say them, the same rules in DuckDB's SQL."""

from __future__ import annotations

from .common import Query

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder) -> DataFrame`` under ``name``."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add
