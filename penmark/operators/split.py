"""Seeded train / val / test splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from penmark.functions.ids import SEED, seeded_bucket
from penmark.operators.positions import seeded_order

# The share held out of training, and the share of that kept for the test.
HELD_OUT = 0.3
TEST_OF_HELD_OUT = 0.5


def split_by_hash(df: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """70/15/15 by a hash of the key: a projection, the same in every run and layout."""
    train = round(100 * (1 - HELD_OUT))
    val = train + round(100 * HELD_OUT * (1 - TEST_OF_HELD_OUT))
    bucket = seeded_bucket(F.col(key), 100, seed)
    return df.withColumn(
        "split", F.when(bucket < train, "train").when(bucket < val, "val").otherwise("test")
    )


def split_exact(df: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """The same shares with exact sizes; the held-out part is rounded up at each step."""
    total = df.agg(F.count(F.lit(1))).scalar()
    held = F.ceil(F.lit(HELD_OUT) * total)
    test = F.ceil(F.lit(TEST_OF_HELD_OUT) * held)
    ranked = seeded_order(df, key, "_rank", seed)
    place = F.col("_rank")
    named = F.when(place < total - held, "train").when(place < total - test, "val").otherwise("test")
    return ranked.withColumn("split", named).drop("_rank")
