"""Clean the main table and remove characters that give a class away."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from penmark.functions.rows import one_per_item
from penmark.functions.text import characters, clean_text, drop_characters
from penmark.operators.curate import GENERATED, HUMAN
from penmark.operators.dedup import keep_first


def drop_null_text(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=["text"])


def known_classes(df: DataFrame) -> DataFrame:
    """Rows labelled human or generated; any other label leaves the table."""
    return df.where(F.col("label").isin(HUMAN, GENERATED))


def _characters(df: DataFrame) -> DataFrame:
    """Label and character, once per text; an empty text has none."""
    return one_per_item(df, ["label"], characters(F.col("text")), "ch").where("ch <> ''")


def class_charset(df: DataFrame) -> DataFrame:
    """The distinct characters of each class. Bounded by the size of Unicode."""
    return _characters(df).distinct()


def generated_only_chars(df: DataFrame) -> DataFrame:
    """Characters seen in generated texts and in no human text, in one aggregation."""
    by_char = _characters(df).groupBy("ch").agg(
        F.max(F.col("label") == HUMAN).alias("in_human"),
        F.max(F.col("label") == GENERATED).alias("in_generated"),
    )
    return by_char.where("in_generated AND NOT in_human").select("ch")


def strip_generated_only(df: DataFrame) -> DataFrame:
    """Delete those characters from the generated texts.

    The set is one short string (at most every code point once), so it enters the plan
    as a scalar subquery: no join, no collect in this code.
    """
    unwanted = generated_only_chars(df).agg(
        F.array_join(F.array_sort(F.collect_set("ch")), "").alias("chars")
    )
    stripped = drop_characters(F.col("text"), unwanted.scalar())
    return df.withColumn("text", F.when(F.col("label") == GENERATED, stripped).otherwise(F.col("text")))


def clean_corpus(main: DataFrame, **switches: bool) -> DataFrame:
    """The whole cleaning of a main table (``text``, ``label``, ``text_id``).

    De-duplication looks at the raw text, so texts made equal or empty by cleaning stay.
    A null ``text_id`` is kept like any other. The condition on both columns takes away no row
    that has a class; it makes the character set and the rows ask for the same columns of
    the de-duplicated table, so they share one shuffle.
    """
    first = main.transform(drop_null_text).transform(keep_first, ["text"], "text_id")
    first = first.where("text_id IS NOT NULL OR label IS NOT NULL")
    cleaned = first.withColumn("text", clean_text(F.col("text"), **switches))
    return cleaned.transform(known_classes).transform(strip_generated_only)
