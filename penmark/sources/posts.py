"""Landed posts and generated texts as labelled records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from penmark.functions.rows import one_per_item
from penmark.operators.curate import GENERATED, HUMAN

# How a record names its source.
USER_SOURCE = "Twitter API v2"
KEYWORD_SOURCE = "Twitter API v2 - Keyword (%s)"
RANGE_SOURCE = "Twitter API v2 - Time Range (%s ~ %s)"


def _newest(posts: DataFrame, n: int) -> DataFrame:
    """The n newest posts: each task keeps its own n, one merge keeps n of those."""
    return posts.orderBy(F.desc("created_at"), F.desc("text_id")).limit(n)


def _records(posts: DataFrame, username: Column, source: Column) -> DataFrame:
    return posts.select(
        "text_id", "text", "user_id", F.lit(HUMAN).alias("label"), username.alias("username"),
        "created_at", source.alias("source"),
    )


def _mentions(keyword: str) -> Column:
    return F.contains(F.lower("text"), F.lower(F.lit(keyword)))


def posts_by_user(posts: DataFrame, user_id: int, username: str, n: int = 5) -> DataFrame:
    """One author's newest posts."""
    own = posts.where(F.col("user_id") == user_id)
    return _records(_newest(own, n), F.lit(username), F.lit(USER_SOURCE))


def posts_by_keyword(posts: DataFrame, keyword: str = "#AI", n: int = 10) -> DataFrame:
    """The newest posts containing a keyword, whatever its case."""
    found = _newest(posts.where(_mentions(keyword)), n)
    return _records(found, F.lit(None).cast("string"), F.lit(KEYWORD_SOURCE % keyword))


def posts_in_range(posts: DataFrame, keyword: str, start: str, end: str, n: int = 10) -> DataFrame:
    """As :func:`posts_by_keyword`, from ``start`` (included) to ``end`` (excluded)."""
    at = F.col("created_at")
    inside = (at >= F.to_timestamp_ntz(F.lit(start))) & (at < F.to_timestamp_ntz(F.lit(end)))
    found = _newest(posts.where(_mentions(keyword) & inside), n)
    return _records(found, F.lit(None).cast("string"), F.lit(RANGE_SOURCE % (start, end)))


def generated_records(
    runs: DataFrame, texts: str, keys: list[str], model: str = "gpt-4o-mini", temperature: float = 0.7
) -> DataFrame:
    """One record per generated text of a run, numbered in the order of its prompts."""
    rows = one_per_item(runs, keys, texts, "text", "at")
    return rows.select(
        *keys,
        F.concat(F.lit("gen_"), F.col("at")).alias("text_id"),
        "text",
        F.lit(GENERATED).alias("label"),
        F.concat(F.lit("prompt_"), F.col("at")).alias("prompt_name"),
        F.lit(model).alias("model"),
        F.lit(temperature).alias("temperature"),
    )
