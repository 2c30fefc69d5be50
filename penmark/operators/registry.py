"""The catalogue of saved models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from penmark.functions import naming
from penmark.functions.scoring import fixed
from penmark.operators.positions import positions
from penmark.session import materialise

MENU = {"accuracy": "accuracy", "time": "timestamp", "name": "name", "size": "size_mb"}  # the column of each order


def catalogue(files: DataFrame) -> DataFrame:
    """``path, size, modified`` with everything the file name says."""
    named = files.withColumn("name", naming.base_name(F.col("path")))
    return naming.parse_model_name(named.withColumn("size_mb", naming.size_mb(F.col("size"))))


def best_first() -> list[Column]:
    """Accuracy, then time (missing last), then path."""
    return [F.desc("accuracy"), F.desc_nulls_last("timestamp"), F.asc("path")]


def order_of(choice: str) -> list[Column]:
    """The sort menu. A missing number counts as 0, a missing time comes last."""
    orders = {
        "accuracy": [F.coalesce("accuracy", F.lit(0.0)).desc()],
        "time": [F.desc_nulls_last("timestamp")],
        "name": [F.asc("name")],
        "size": [F.coalesce("size_mb", F.lit(0.0)).desc()],
    }
    if choice not in orders:
        raise ValueError(f"unknown order {choice!r}; one of {sorted(orders)}")
    return [*orders[choice], F.asc("path")]


def ranked(models: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Models with their rank 0.. in the given order (best first by default)."""
    return positions(models, order or best_first(), "rank")


def ranked_each(models: DataFrame) -> DataFrame:
    """``sort_by, path, rank``: every order of the menu. Names are read once and stored; a sort moves its own column and the path only."""
    read = materialise(models.select("path", *MENU.values()))
    each = [
        ranked(read.select("path", column), order_of(choice)).select(F.lit(choice).alias("sort_by"), "path", "rank")
        for choice, column in MENU.items()
    ]
    return reduce(DataFrame.unionByName, each)


def best(models: DataFrame) -> DataFrame:
    return models.orderBy(*best_first()).limit(1)


def mark_current(models: DataFrame, current: str | Column) -> DataFrame:
    """``current`` is a path, or a scalar subquery that gives one."""
    return models.withColumn("is_current", F.col("path").eqNullSafe(F.lit(current)))


def find_models(models: DataFrame, wanted: DataFrame, path: str = "path") -> DataFrame:
    """Every wanted path with its model; a path that is not in the catalogue has an ``error``."""
    found = wanted.select(F.col(path).alias("path")).join(models.withColumn("_known", F.lit(True)), "path", "left")
    missing = F.when(F.col("_known").isNull(), F.concat(F.lit("Model not found: "), "path"))
    return found.withColumn("error", missing).drop("_known")


def listing(models: DataFrame) -> DataFrame:
    """The summary line and the menu entry of each model."""
    size = F.col("size_mb").cast("string")
    shown = F.concat(fixed(F.col("accuracy"), 1), F.lit("%"))
    known = F.concat(
        F.col("name"), F.lit(" ("), size, F.lit(" MB) - "), F.col("model_type"), F.lit(" "),
        shown, F.lit(" ("), F.col("formatted_time"), F.lit(")"),
    )
    unknown = F.concat(F.col("name"), F.lit(" ("), size, F.lit(" MB) - Unknown format"))
    entry = F.concat(F.col("name"), F.lit(" ("), size, F.lit(" MB)"))
    typed = F.concat(F.col("model_type"), F.lit(" "), F.col("accuracy").cast("string"), F.lit("% - "), entry)
    current = F.when(F.col("is_current"), " [CURRENT]").otherwise("")
    return models.withColumns(
        {
            "line": F.when(F.col("parsed"), known).otherwise(unknown),
            "entry": F.concat(F.when(F.col("parsed"), typed).otherwise(entry), current),
        }
    )
