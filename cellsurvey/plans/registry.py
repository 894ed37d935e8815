"""Registry of queries and of the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsurvey.plans.bindings import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` as a query, with its SQL where SQL can state it."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Round floating results, so that the order of summation does not show."""
    return df.withColumns({c: F.round(c, digits) for c in cols})
