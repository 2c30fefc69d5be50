"""Operator 6, approximate nearest neighbours by inner product over shifted Hilbert curves.

1. Vectors that are null, zero, of another length or hold null or non-finite components take no part. Equal vectors are one class (with its
   21 smallest ids, all that any answer can name), so thousands of copies are one point of the index.
2. Largest inner product becomes smallest distance: every vector gets one more component, ``sqrt(M^2 - |x|^2)`` with the largest norm
   ``M``; a query gets 0 there. For unit vectors nothing changes.
3. ``ORDERINGS`` times, vectors are projected on ``DIMS`` random orthonormal directions, shifted by a random offset and placed on a Hilbert
   curve. Spark range-sorts (ordering, key) and numbers the rows; ``BLOCK`` neighbours on the curve form a block.
4. A query is compared with all vectors of its block and of the two next to it, in every ordering, in double precision. A block grows
   with the table. A task holds at most about ``PART`` vectors of it and the queries that visit it.
5. The best of all orderings are merged and ranked, copies are named, the query itself left out. Ties go to the smaller id.

Recall depends on the share of the table that the blocks of all orderings hold and on how far the data is from isotropic; the README has measured
values. Null ids are not indexed and not queried. Repeated ids: each row is a candidate and, if its id is asked for, a query of its own, which
leaves out one row only, itself. Vectors of a length other than the commonest have no inner product with the rest. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from penmark.llm.common import arrow, store
from penmark.operators.positions import positions

ORDERINGS, DIMS, BITS, BLOCK, SEED = 24, 8, 7, 1024, 5
K, EVERY = 20, 20
BLOCKS = 50  # at most so many blocks an ordering: what a query is compared with stays the same share of a larger table
PART = 8192  # vectors of a block that a task holds


def block_size(n: int, block: int = BLOCK) -> int:
    """Rows of a block for ``n`` places on the curve."""
    return max(block, -(-n // BLOCKS))


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of integer points (one per row, each coordinate below ``2**bits``) on the Hilbert curve."""
    axes = [c.astype(np.uint64) for c in cells.T]
    zero = np.uint64(0)
    for level in range(bits - 1, 0, -1):  # undo the turns of each level, coarsest first
        bit, below = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for i in range(len(axes)):
            flip = (axes[i] & bit) != zero
            swap = np.where(flip, zero, (axes[0] ^ axes[i]) & below)
            axes[0] = axes[0] ^ swap ^ np.where(flip, below, zero)
            axes[i] = axes[i] ^ swap if i else axes[0]
    for i in range(1, len(axes)):  # Gray code across the axes
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros(len(cells), np.uint64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(axes[-1] & np.uint64(1 << level), np.uint64((1 << level) - 1), zero)
    key = np.zeros(len(cells), np.uint64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << np.uint64(1)) | (((axis ^ turn) >> np.uint64(level)) & np.uint64(1))
    return key.view(np.int64)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` (doubles) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND size(v) > 0")
    rows = rows.where(~bad).where(F.exists("v", lambda x: x != 0))
    length = rows.agg(F.mode(F.size("v"), True)).scalar()
    return rows.where(F.size("v") == length)


def _matrix(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1) if len(lists) else np.zeros((0, 1))


def _moments(classes: DataFrame) -> tuple[int, int, float, float]:
    """Classes, components, largest norm, mean square of a component."""
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, dims, largest, mean = classes.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(square), F.avg(square / F.size("v"))).first()
    return n, dims or 0, math.sqrt(largest or 0.0), mean or 0.0


def _keys(dims: int, largest: float, spread: float, orderings: int, bits: int):
    low = min(DIMS, dims + 1)
    rng = np.random.default_rng(SEED)
    ways = [np.linalg.qr(rng.normal(size=(dims + 1, low)))[0] for _ in range(orderings)]
    shifts = rng.uniform(0, 0.5, (orderings, low))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, ids = _matrix(batch.column("v")), batch.column("rep")
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            norm = np.sqrt((x * x).sum(axis=1))
            data = np.hstack([x, np.sqrt(np.maximum(largest**2 - norm**2, 0))[:, None]])
            query = np.hstack([x * (largest / norm)[:, None], np.zeros((len(x), 1))])[asks]
            for t, (way, shift) in enumerate(zip(ways, shifts)):
                for points, own, role in ((data, ids, False), (query, ids.filter(pa.array(asks)), True)):
                    place = (points @ way / (8 * spread) + 0.5) / 2 + shift  # four deviations on each side fill half a side
                    cells = np.clip(place * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
                    n = len(points)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, t, np.int32)), pa.array(hilbert_keys(cells, bits)), own, pa.array(np.full(n, role))],
                        names=["t", "key", "rep", "query"],
                    )

    return run


def _best(k: int):
    """The ``k`` nearest vectors of a block for each query that visits it (more if the last ones tie)."""

    def run(block: pa.Table) -> pa.Table:
        is_query = block.column("query").to_numpy()
        x, ids = _matrix(block.column("v")), block.column("rep").to_numpy()
        data, own = x[~is_query], ids[~is_query]
        out: list[list[np.ndarray]] = [[], [], []]
        for at in range(0, int(is_query.sum()) if len(data) else 0, 256):
            some, asked = x[is_query][at : at + 256], ids[is_query][at : at + 256]
            near = some @ data.T
            least = np.partition(near, len(data) - k, axis=1)[:, -k] if len(data) > k else np.full(len(some), -np.inf)
            q, d = np.nonzero(near >= (least - 1e-9 * (1 + np.abs(least)))[:, None]) if len(data) > k else np.nonzero(np.ones_like(near))
            for column, values in zip(out, (asked[q], own[d], np.einsum("ij,ij->i", some[q], data[d]))):
                column.append(values)
        q, d, s = (np.concatenate(c) if c else np.zeros(0) for c in out)
        return pa.table({"query": pa.array(q.astype(np.int64)), "rep": pa.array(d.astype(np.int64)), "score": pa.array(s.astype(float))})

    return run


def nearest(vectors: DataFrame, asked: Column, k: int = K, orderings: int = ORDERINGS, block: int = BLOCK, bits: int = BITS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for the rows where ``asked`` (over ``vec_id``) holds, the ``k`` nearest other rows found."""
    rows = usable(vectors)
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    named = rows.withColumn("_n", first).where(F.col("_n") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("members"))
    asking = rows.where(asked).groupBy("v").agg(F.count(F.lit(1)).alias("asks"))
    classes = named.join(asking, "v", "left").select(
        F.monotonically_increasing_id().alias("rep"), "v", "members", F.col("asks").isNotNull().alias("asks"))
    classes = store(classes, "op6-classes")  # numbered once: the numbers of the classes are read from here
    n, dims, largest, mean = _moments(classes)
    keys = arrow(classes.select("rep", "v", "asks"), _keys(dims, largest, math.sqrt(mean) or 1.0, orderings, bits), "t int, key long, rep long, query boolean")
    keys = positions(store(keys, "op6-keys"), [F.col("t"), F.col("key"), F.col("rep"), F.col("query")], "pos")
    each = n + classes.where("asks").count()
    block = block_size(each, block)
    parts = -(-block // PART)
    at = F.floor((F.col("pos") - F.col("t").cast("long") * each) / block)
    visits = F.when(F.col("query"), F.array(at - 1, at, at + 1)).otherwise(F.array(at))
    placed = keys.select("t", "rep", "query", F.explode(visits).alias("block"))
    part = F.when(F.col("query"), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.pmod(F.xxhash64("rep"), F.lit(parts)).cast("int")))
    placed = placed.withColumn("part", F.explode(part))
    found = placed.join(classes.select("rep", "v"), "rep").groupBy("t", "block", "part").applyInArrow(_best(k + 1), "query long, rep long, score double")
    found = store(found.groupBy("query", "rep").agg(F.max("score").alias("score")), "op6-found")
    of_class = classes.select("rep", F.col("members")[0].alias("least"))
    by_class = Window.partitionBy("query").orderBy(F.desc("score"), "least")
    top = found.join(of_class, "rep").withColumn("_n", F.row_number().over(by_class)).where(F.col("_n") <= k + 1).drop("_n", "least")
    top = top.join(classes.select("rep", "members"), "rep").select("query", "rep", "score", F.explode("members").alias("vec_id"))
    ids = rows.where(asked).join(classes.select("rep", "v"), "v").select(F.col("rep").alias("query"), F.col("vec_id").alias("query_id"))
    # A query needs the k + 1 best members of its class only; they are cut before the classes meet the queries.
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = top.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1).groupBy("query").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id", "rep"))).alias("near"))
    own = F.transform("near", lambda x: (x["vec_id"] == F.col("query_id")) & (x["rep"] == F.col("query")))
    answer = ids.join(top, "query").withColumn("_own", F.array_position(own, True) - 1)
    others = F.filter("near", lambda x, i: i != F.col("_own"))
    answer = answer.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("rank", "x"))
    return answer.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "x.vec_id", (-F.col("x.far")).alias("score"))
