"""Where plan modules register their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, sf_dir) under a name, with the SQL that says the same."""

    def add(make: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = make
        if sql:
            ORACLE_SQL[name] = sql
        return make

    return add


def ts_ms(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """df with its timestamp as ts_ms, which every engine compares alike."""
    return df.withColumn("ts_ms", F.unix_millis(column)).drop(column)


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), places) for c in columns})


def long(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")
