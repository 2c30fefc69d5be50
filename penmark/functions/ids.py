"""Identifiers and seeded hashes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SEED = 42

# The key format hashed into a canonical id, and the source names used in it.
KEY_SEPARATOR = "::"
POST_SOURCE = "twitter"
GENERATED_SOURCE = "llm"


def canonical_id(source: str, original_id: Column) -> Column:
    """SHA-1 of source and original id, as 40 hex digits."""
    return F.sha1(F.concat_ws(KEY_SEPARATOR, F.lit(source), original_id.cast("string")))


def seeded_hash(key: Column, seed: int = SEED) -> Column:
    """A hash that depends on nothing but the key and the seed."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def seeded_bucket(key: Column, buckets: int = 100, seed: int = SEED) -> Column:
    """A bucket number 0..buckets-1 from the first 32 bits of the seeded hash."""
    head = F.conv(F.substring(seeded_hash(key, seed), 1, 8), 16, 10).cast("bigint")
    return (head % buckets).cast("int")
