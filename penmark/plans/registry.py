"""Where queries register themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its equivalent over the same tables."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register


def shown(array: Column) -> Column:
    """An array as text, for results that are compared by value."""
    return F.array_join(array.cast("array<string>"), ",")


def shown_time(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss")


def rounded(value: Column, digits: int = 6) -> Column:
    """A double with its last bits taken off, and without a negative zero."""
    out = F.round(value, digits)
    return F.when(out == 0, F.lit(0.0)).otherwise(out)
