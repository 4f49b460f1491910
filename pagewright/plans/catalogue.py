"""All queries of the library and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagewright.plans import catalog_queries, file_queries, html_queries, layout_queries, page_queries, registry, relational_queries, task_queries, text_queries, tree_queries  # noqa: F401  they register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.SQL)
