"""Queries by name, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, *sql: str):
    """Register a query. ``sql`` is one text, or WITH parts followed by the main SELECT."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = function
        if sql:
            *parts, main = sql
            SQL[name] = (f"WITH {', '.join(parts)}\n" if parts else "") + main.strip()
        return function

    return add
