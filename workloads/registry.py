"""Names, queries and their SQL. A query takes (spark, directory of the tables)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DAY1 = datetime(2026, 5, 26)
DAY2 = datetime(2026, 5, 27)
DAY3 = datetime(2026, 5, 28)


def register(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return add


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")
