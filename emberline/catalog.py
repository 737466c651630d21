"""The queries of the detection engine and the SQL that states the same results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import grid_queries, ingest_queries, product_queries, registry, report_queries, support_queries, web_queries

MODULES = (grid_queries, ingest_queries, product_queries, report_queries, support_queries, web_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.SQL)
