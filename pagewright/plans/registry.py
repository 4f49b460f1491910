"""Registry of queries and of the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of (spark, folder) under a name; sql may start with CTE bodies and is put behind WITH."""

    def add(f):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql:
            s = sql.strip()
            SQL[name] = s if s[:6].upper() == "SELECT" else f"WITH {s}"
        return f

    return add
