"""Arrays to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def one_per_item(df: DataFrame, keep: list[str], array, item: str, at: str | None = None) -> DataFrame:
    """One row per array element (and its position ``at``), none for an empty array.

    The inner ``explode`` makes Spark test the array for emptiness below it, which
    evaluates the expression that builds the array again; the outer form does not.
    """
    if at is None:
        rows = df.select(*keep, F.explode_outer(array).alias(item))
        return rows.where(F.col(item).isNotNull())
    rows = df.select(*keep, F.posexplode_outer(array).alias(at, item))
    return rows.where(F.col(at).isNotNull())
