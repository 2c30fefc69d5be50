"""Operator 5, sharding by a Feistel permutation with cycle walking over global row numbers.

Rows are numbered 0..n-1 in the order of ``doc_id`` (null last; ties by checksum and size). A keyed Feistel network permutes the numbers below
the next power of two; a number that leaves 0..n-1 walks on along its cycle until it is back, so 0..n-1 is permuted onto itself. With the
permuted number ``p``: ``shard = p mod shards`` and ``slot = p div shards``. Both follow from row number, ``n`` and seed alone, so
the shuffle can be repeated and any row found without reading the others; shards differ by one row at most (law ``rows``).

Row numbers come from one range sort of narrow rows (no text), kept in the shared folder, and one offset per partition. Built-in
functions only. Null text has size 16 and checksum 0. Rows equal in every digest column are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from penmark.llm.common import store
from penmark.operators.positions import positions

SHARDS, ROUNDS, SEED, WALKS = 40, 4, 20240601, 64


def _feistel(x: Column, bits: int, rounds: int = ROUNDS, seed: int = SEED) -> Column:
    """One pass over numbers of ``bits`` bits. The halves may differ by one bit and change places every round."""
    low, high = bits // 2, bits - bits // 2
    left, right = F.shiftright(x, low), x.bitwiseAND(F.lit((1 << low) - 1))
    for i in range(rounds):
        width = high if i % 2 == 0 else low  # of the half that is changed
        key = F.xxhash64(right, F.lit(i), F.lit(seed)).bitwiseAND(F.lit((1 << width) - 1))
        left, right = right, left.bitwiseXOR(key)
    # After an even number of rounds the halves have their widths back.
    return F.shiftleft(left, low).bitwiseOR(right)


def permuted(row: Column, n: int, seed: int = SEED) -> Column:
    """The place of row number ``row`` in the seeded permutation of 0..n-1.

    A walk goes on with a chance of one half at most, so 64 steps are never used up in practice; should they be, the query fails
    rather than giving a wrong place.
    """
    if n < 2:
        return row
    bits = max(2, (n - 1).bit_length())
    walk = F.aggregate(
        F.sequence(F.lit(2), F.lit(WALKS)), _feistel(row, bits, seed=seed),
        lambda at, _: F.when(at < n, at).otherwise(_feistel(at, bits, seed=seed)),
    )
    return F.when(walk < n, walk).otherwise(F.raise_error(F.lit("the walk did not return")).cast("long"))


def numbered(rows: DataFrame) -> DataFrame:
    """``row``: 0..n-1 in the order of ``doc_id, text_crc32, size``."""
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_crc32"), F.col("size")]
    return positions(rows, order, "row")


def assign(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` and ``row``, the global row number."""
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(data).cast("long") + 16).alias("size"),
        F.crc32(data).alias("text_crc32"),
    )
    rows = store(numbered(rows), "op5-rows")
    n = rows.count()
    return rows.withColumn("_p", permuted(F.col("row"), n, seed)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (F.col("_p") % shards).cast("int").alias("shard"),
        F.floor(F.col("_p") / shards).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "row",
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Write the rows of ``docs`` (unique ``doc_id``) with their slot as Parquet, one folder per shard."""
    places = assign(docs, shards, seed).select("doc_id", "shard", "slot")
    docs.join(places, docs["doc_id"].eqNullSafe(places["doc_id"])).drop(places["doc_id"]).write.partitionBy("shard").parquet(path)
