"""Left equi-join against a table with one row per key."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from penmark.session import stored

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_PARTS = 1000  # a key is hot above 1/1000 of the rows, so there are fewer than 1000
BLOCK_ROWS = 5000  # rows of a block, at most: half of an Arrow batch


def _width(field: T.StructField) -> Column:
    kind = field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.size(field.name), F.lit(0)) * 8 + 16
    return F.lit(8)


def measured_bytes(df: DataFrame) -> int:
    """Size of a table, measured. Meant for one that is cheap to read (stored)."""
    width = sum((_width(f) for f in df.schema.fields), F.lit(16))
    return df.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()[0]


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    *,
    spread_by: list[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    weight: str | None = None,
    table_bytes: int | None = None,
) -> DataFrame:
    """``rows`` left joined to ``table`` on ``key``.

    A table measured to be small is broadcast. A larger one is joined by shuffle, except
    for the hot keys of ``rows``: fewer than 1000 keys can each hold over a thousandth of
    the rows, so their part of the table is broadcast whatever the data, and their rows
    are spread over salts (from ``spread_by``) instead of meeting in one task.

    ``weight`` names a column of the table that holds how often its key occurs (a vocabulary's own counts). Hot keys are
    then read off the table and the rows are not counted; the column is not part of the result. ``table_bytes`` is the
    size of the table where it was measured before, so that building the plan starts no job.
    """
    values = [c for c in table.columns if c not in (key, weight)]
    if (measured_bytes(table) if table_bytes is None else table_bytes) <= broadcast_bytes:
        return rows.join(F.broadcast(table.select(key, *values)), key, "left").select(*rows.columns, *values)

    if weight:
        counts = table.select(key, F.col(weight).alias("_n"))
        table = table.drop(weight)
    else:
        counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    limit = counts.agg(F.sum("_n") / HOT_PARTS).scalar()
    hot_keys = counts.where(F.col("_n") > limit).select(key)
    hot = hot_keys.join(table, key, "left").select(
        key, F.lit(True).alias("_hot"), *[F.col(v).alias(f"_hot_{v}") for v in values]
    )
    spread = F.pmod(F.xxhash64(*spread_by), F.lit(HOT_PARTS)) + 1
    salted = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.when(F.col("_hot") | F.col(key).isNull(), spread).otherwise(F.lit(0))
    )
    joined = salted.join(table.withColumn("_salt", F.lit(0).cast("bigint")), [key, "_salt"], "left")
    chosen = [
        F.when(F.col("_hot"), F.col(f"_hot_{v}")).otherwise(F.col(v)).alias(v) for v in values
    ]
    return joined.select(*rows.columns, *chosen)


Filled = Callable[[pa.Array, pa.Array, pa.Array, np.ndarray], pa.Array]


def _readers():
    """Made here so that tasks get them by value: executors need not have this package."""

    def runs(batch: pa.RecordBatch, *columns: str) -> Iterator[pa.RecordBatch]:
        """Parts of a batch in which the columns (numbers or booleans) do not change."""
        held = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
        new = np.any([x[1:] != x[:-1] for x in held], axis=0) if batch.num_rows else np.zeros(0, bool)
        ends = [*(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        yield from (batch.slice(start, end - start) for start, end in zip([0, *ends], ends) if end > start)

    def items_of(part: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
        """All items of the rows one after the other, and how many each row has."""
        lists = part.column("_items")
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        flat = lists.flatten()
        if "_text" not in part.schema.names:
            return flat, counts
        # strings travel as one text a row and the bytes of each
        text = part.column("_text")
        start = np.frombuffer(text.buffers()[1], np.int32, 1, text.offset * 4)
        offsets = np.concatenate((start, start + np.cumsum(pc.fill_null(flat, 0).to_numpy()))).astype(np.int32)
        held = pa.py_buffer(np.packbits(flat.is_valid().to_numpy(zero_copy_only=False), bitorder="little"))
        return pa.StringArray.from_buffers(len(flat), pa.py_buffer(offsets), text.buffers()[2] or pa.py_buffer(b""), held), counts

    return runs, items_of


def lookup_arrays(
    df: DataFrame, keys: list[str], items: str, table: DataFrame, key: str, value: str, out: T.StructField, fill: Filled, **options
) -> DataFrame:
    """``keys`` of every row, and ``out``: its array ``items`` looked up in ``table`` on ``key``.

    Rows form blocks where they lie: the distinct items of a block are numbered, and its rows are stored as arrays of these numbers. The
    distinct items, not the items, meet the table (:func:`lookup`, with ``options``), so a frequent item costs one row a block, and only
    numbers move. What is found comes first in the task of the block and is all that it holds besides one batch of rows;
    ``fill(numbers found, their values, items as numbers, items of each row)`` gives the column ``out`` of a batch; a null item is -1.
    ``_stored_at`` of the result says where the stored rows lie.
    """
    placed = df.select(*keys, F.coalesce(items, F.array()).alias("_items"))  # null lists cost time with the square of an Arrow batch
    kind = df.schema[items].dataType.elementType
    if isinstance(kind, T.StringType):
        sizes = F.transform("_items", F.octet_length)
        placed = placed.withColumns({"_items": sizes, "_text": F.array_join("_items", "")})
    runs, items_of = _readers()
    most = BLOCK_ROWS

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                flat, counts = items_of(part)
                found = flat.dictionary_encode()
                offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
                rows, seen = len(counts), len(found.dictionary)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(block), rows), *(part.column(k) for k in keys), pa.nulls(rows, flat.type), pa.repeat(pa.scalar(-1, pa.int32()), rows),
                     pa.ListArray.from_arrays(offsets, pc.fill_null(found.indices, -1))], names=names)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(block), seen), *(pa.nulls(seen, part.column(k).type) for k in keys), found.dictionary, pa.array(np.arange(seen, dtype=np.int32)),
                     pa.ListArray.from_arrays(pa.array(np.zeros(seen + 1, np.int32)), pa.nulls(0, pa.int32()))], names=names)
                block += 1

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, known, joined = None, [], None
        for batch in batches:
            for part in runs(batch, "_block", "_held"):
                if part.column("_block")[0] != block:
                    block, known, joined = part.column("_block")[0], [part.slice(0, 0)], None
                if part.column("_held")[0].as_py():
                    known.append(part)
                    continue
                if joined is None:
                    joined = [pa.concat_arrays([p.column(c) for p in known]) for c in ("_number", "_value")]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in keys), fill(*joined, *items_of(part))], names=[*keys, out.name])

    own = [T.StructField(k, df.schema[k].dataType) for k in keys]
    schema = T.StructType([
        T.StructField("_block", T.LongType()), *own, T.StructField("_item", kind), T.StructField("_number", T.IntegerType()),
        T.StructField("_items", T.ArrayType(T.IntegerType()))])
    names = schema.names
    both, path = stored(placed.mapInArrow(numbered, schema), "numbered")
    wanted = both.where("_number >= 0 AND _item IS NOT NULL").select("_block", "_number", F.col("_item").alias(key))
    found = lookup(wanted, table, key, spread_by=["_block", key], **options)
    held = found.where(F.col(value).isNotNull()).select(
        "_block", "_number", F.col(value).alias("_value"), F.array().cast("array<int>").alias("_items"), F.lit(True).alias("_held"))
    none = F.array().cast(table.schema[value].dataType) if isinstance(table.schema[value].dataType, T.ArrayType) else F.lit(None)
    texts = both.where("_number < 0").select("_block", *keys, "_number", none.cast(table.schema[value].dataType).alias("_value"), "_items", F.lit(False).alias("_held"))
    rows = held.unionByName(texts, allowMissingColumns=True)
    rows = rows.repartition("_block").sortWithinPartitions("_block", F.desc("_held"))
    result = rows.mapInArrow(filled, T.StructType([*own, out]))
    result._stored_at = path
    return result
