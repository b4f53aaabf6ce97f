"""The registered queries and, where SQL can express them, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function ``(spark, sf_dir) -> DataFrame`` under a name."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Round computed doubles, so that the order of additions does not show."""
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})


def at(array: Column, i: int) -> Column:
    return F.get(array, F.lit(i))
