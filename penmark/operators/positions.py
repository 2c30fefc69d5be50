"""Dense ids, batches, shuffles and ranks, without a window over the whole table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from penmark.functions.ids import SEED, seeded_hash
from penmark.session import materialise

CHUNK_BITS = 16  # a chunk of unique integer positions has at most 2**16 rows
COARSE_BITS = 20  # chunks are summed in groups of at most 2**20
_LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition above this bit


def chunk_of(position: Column, bits: int = CHUNK_BITS) -> Column:
    """The chunk of an integer position; chunks follow the order of the positions."""
    return F.shiftright(position, bits)


def chunk_or_any(chunk: Column, columns: list[str]) -> Column:
    """``chunk``, or where it is null one of 65,536 chunks before all others, by a hash of the row."""
    return F.coalesce(chunk.cast("bigint"), -1 - F.pmod(F.xxhash64(*columns), F.lit(1 << CHUNK_BITS)))


def _join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which null keys meet each other; columns of ``left``, then the others of ``right``."""
    named = right.select(*[F.col(k).alias(f"_right_{k}") if k in keys else F.col(k) for k in right.columns])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(named, same).drop(*[f"_right_{k}" for k in keys])


def _before(by: list[str], order: list[str]) -> Column:
    """Running sum of ``_n`` over the earlier rows."""
    window = Window.partitionBy(*by).orderBy(*order) if by else Window.orderBy(*order)
    return F.coalesce(F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _first_of_each(sizes: DataFrame, keys: list[str]) -> DataFrame:
    """Number of rows in all earlier chunks, in two levels.

    Neighbouring chunks are summed into groups; the groups are few enough for one window,
    and the chunks of a group are summed next to each other. So sparse positions, which
    make many small chunks, still put no more than 2**20 chunk sizes into one task.
    """
    *outer, last = keys
    grouped = sizes.withColumn("_group", F.shiftright(last, COARSE_BITS))
    by = [*outer, "_group"]
    totals = grouped.groupBy(*by).agg(F.sum("_n").alias("_n"))
    starts = totals.select(*by, _before([], by).alias("_start"))
    inside = grouped.select(*by, last, _before(by, [last]).alias("_inside"))
    return _join(inside, starts, by).select(*keys, (F.col("_start") + F.col("_inside")).alias("_first"))


def dense_ids(df: DataFrame, order: list[str], chunk: list[str], name: str) -> DataFrame:
    """Ids 0..n-1 in the order of (``chunk``, ``order``).

    No row is lost: nulls are values of their own and come first.
    ``chunk`` must be a coarse prefix of the order, its last column an integer,
    with a bounded number of rows in each value (a file, ``chunk_of(position)`` of unique
    positions, the head of a hash). Rows are numbered
    inside their chunk and shifted by the size of the chunks before. That size is one more row of
    the chunk, its first: so the rows move once, and meet no join that would deal them again.
    """
    sizes = df.groupBy(*chunk).agg(F.count(F.lit(1)).alias("_n"))
    first = _first_of_each(sizes, chunk).withColumn("_row", F.lit(False))
    rows = df.withColumn("_row", F.lit(True)).unionByName(first, allowMissingColumns=True)
    along = Window.partitionBy(*chunk).orderBy("_row", *order)
    numbered = rows.withColumns({"_at": F.row_number().over(along), "_before": F.max("_first").over(along.rowsBetween(Window.unboundedPreceding, 0))})
    return numbered.where("_row").withColumn(name, F.col("_before") + F.col("_at") - 2).drop("_row", "_first", "_at", "_before")


def positions(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Ids 0..n-1 along any unique order (strings, mixed directions).

    The rows are range sorted and stored once, because a second run of a sampled range
    partitioning may cut elsewhere. The offsets table has one row per partition, which is
    why it may be broadcast.
    """
    stored = materialise(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _LOCAL_BITS)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    first = sizes.select("_part", _before([], ["_part"]).alias("_first"))
    local = F.col("_at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(first), "_part")
        .withColumn(name, F.col("_first") + local)
        .drop("_at", "_part", "_first")
    )


def batches(df: DataFrame, key: str, size: int) -> DataFrame:
    """``batch_id`` for batches of ``size`` rows in the order of an integer key, null keys first."""
    placed = df.withColumn("_chunk", chunk_or_any(chunk_of(F.col(key)), df.columns))
    numbered = dense_ids(placed, [key], ["_chunk"], "_id").drop("_chunk")
    return numbered.withColumn("batch_id", F.floor(F.col("_id") / size)).drop("_id")


def seeded_order(df: DataFrame, key: str, name: str, seed: int = SEED) -> DataFrame:
    """Place of each row in the seeded shuffle: its rank by the seeded hash of ``key``.

    The first four hex digits give 65,536 even chunks whatever the keys look like.
    """
    hashed = df.withColumn("_hash", seeded_hash(F.col(key), seed))
    head = F.conv(F.substring("_hash", 1, 4), 16, 10)
    placed = hashed.withColumn("_chunk", chunk_or_any(head, df.columns))
    return dense_ids(placed, ["_hash"], ["_chunk"], name).drop("_chunk", "_hash")
