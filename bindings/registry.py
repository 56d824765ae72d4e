"""Collects the queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.tables import Tables
from chronoweave.session import use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under an operator name."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(use_utc(spark), sf_dir))

        run.__name__ = run.__qualname__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def r6(value: Column | str) -> Column:
    """Round for comparison; adding zero turns -0.0 into 0.0."""
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column.cast("double"), 6) + F.lit(0.0)


def q6(expression: str) -> str:
    """SQL twin of :func:`r6`."""
    return f"(round(CAST({expression} AS DOUBLE), 6) + CAST(0 AS DOUBLE))"
