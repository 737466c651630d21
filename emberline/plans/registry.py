"""Where queries register: a function (spark, sf_dir) -> DataFrame, and SQL for the same rows where SQL can state it."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import small_broadcasts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        @wraps(f)
        def planned(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_broadcasts(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = planned
        if sql is not None:
            SQL[f.__name__] = re.sub(r"(?<![\w.])(\d+\.\d+)(?![\w.])", r"\1e0", sql)  # doubles, as in Spark, not decimals
        return f

    return register
