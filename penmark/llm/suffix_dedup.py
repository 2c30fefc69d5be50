"""Operator 2, suffix-array dedup by bucket-pointer refinement.

Suffixes (window starts) are put into buckets and the buckets are split by the identifiers of blocks at other offsets, until every
bucket holds equal windows of ``size`` bytes or one window only:

1. *q-gram buckets*: every window belongs to the bucket of its anchor gram (see :mod:`common`). Buckets with one group are done.
2. *context*: groups of a bucket are split by the identifier of all bytes their windows cover. A context that occurs twice makes
   all its windows repeated; a bucket with one context is done. All later steps see one group per context.
3. *blocks*: groups of buckets that stay mixed are split into blocks of 16 window starts. A block's bucket is the identifier of the
   bytes its windows share; it is refined by the identifier of all the bytes they cover, with the same rules as in 2.
4. *windows*: the windows of blocks that stay mixed, by the identifier of their own ``size`` bytes within the block's bucket.

Identifiers have 128 bits (3 and 4: with the bucket's). A hot bucket never meets in one task: every step counts
identifiers with a partial aggregation and joins the counts back, which Spark may split.

Null and empty texts have no window. Rows equal in id and text are separate documents (each repeats the other). Order of rows and
further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from penmark.llm.common import (
    CHUNK, anchor_groups, arrow, byte_symbols, chunks, keyed, mix, rolling, slices, store, utf8,
)

SIZE, GRAM, BLOCK = 400, 128, 16
KEY = ["__k1", "__k2"]
_GROUP = "__k1 long, __k2 long, lo long, n int, off int, gram long, c1 long, c2 long"
_SLICE = "__k1 long, __k2 long, lo long, n int, off int, gram long, weight int, bytes binary"
_SLICE_ARROW = pa.schema([(c, pa.binary() if t == "binary" else pa.int32() if t == "int" else pa.int64())
                          for c, t in (x.split() for x in _SLICE.split(", "))])
_BLOCK = "__k1 long, __k2 long, lo long, step int, many int, weight int, core long, full long"
_WINDOW = "__k1 long, __k2 long, at long, weight int, core long, window long"


def _groups(size: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            k1, k2 = (batch.column(k).to_numpy() for k in KEY)
            texts = utf8(batch.column("text"))
            for parts in chunks(np.array([len(t) for t in texts]), size):
                rows, starts, ends = map(np.array, zip(*parts))
                data = b"".join(texts[r][a:b] for r, a, b in parts)
                stop = np.cumsum(ends - starts)
                g = anchor_groups(byte_symbols()[np.frombuffer(data, np.uint8)], stop, size, gram)
                at = g["part"]
                row = rows[at]
                lo = g["lo"] - np.concatenate(([0], stop[:-1]))[at] + starts[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (k1[row], k2[row], lo, g["n"].astype(np.int32), g["off"].astype(np.int32),
                                           g["gram"], g["c1"], g["c2"])],
                    names=["__k1", "__k2", "lo", "n", "off", "gram", "c1", "c2"],
                )

    return run


def _own_bytes(size: int):
    """The bytes of every group listed with a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            texts, rows = utf8(batch.column("text")), []
            for text, a, b, groups in zip(texts, *(batch.column(c).to_pylist() for c in (*KEY, "groups"))):
                rows += [(a, b, *g.values(), text[g["lo"] : g["lo"] + g["n"] - 1 + size]) for g in groups]
            if rows:
                columns = [pa.array(x, f.type) for x, f in zip(zip(*rows), _SLICE_ARROW)]
                yield pa.RecordBatch.from_arrays(columns, names=_SLICE_ARROW.names)

    return run


def _parts(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """Columns, symbols and where each row's symbols begin, for at most ``CHUNK`` symbols at once."""
    for batch in batches:
        data = batch.column("bytes").to_pylist()
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in names]
        ends = np.cumsum([len(d) for d in data])
        at = 0
        while at < len(data):
            done = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + CHUNK - 1, side="right")))
            part = b"".join(data[at:stop])
            begin = np.concatenate(([0], ends[at : stop - 1] - done)).astype(np.int64)
            yield [c[at:stop] for c in columns], byte_symbols()[np.frombuffer(part, np.uint8)], begin
            at = stop


def _blocks(size: int):
    """Blocks of window starts, aligned to the anchor: what all their windows share, and all they cover."""
    width = max(1, min(BLOCK, size // 4))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (k1, k2, lo, n, off, gram, weight), symbols, begin in _parts(batches, [*KEY, "lo", "n", "off", "gram", "weight"]):
            roll = rolling(symbols)
            own = np.repeat(np.arange(len(n)), n)
            step = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            block = (off[own] - step) // width
            heads = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (block[1:] != block[:-1]))))
            g, b, first = own[heads], block[heads], step[heads]
            many = np.diff(np.append(heads, len(own)))
            shared = begin[g] + off[g] - b * width
            core = mix(roll.of(shared, shared + size - width + 1) ^ mix(gram[g].view(np.uint64) + b.astype(np.uint64)))
            at = begin[g] + first
            shape = mix(((off[g] - first).astype(np.uint64) << np.uint64(32)) | many.astype(np.uint64))
            full = mix(roll.of(at, at + many - 1 + size) ^ shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (k1[g], k2[g], lo[g], first.astype(np.int32), many.astype(np.int32),
                                       weight[g].astype(np.int32), core.view(np.int64), full.view(np.int64))],
                names=["__k1", "__k2", "lo", "step", "many", "weight", "core", "full"],
            )

    return run


def _windows(size: int):
    """Identifiers of the windows of the blocks listed with each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (k1, k2, lo, lists), symbols, begin in _parts(batches, [*KEY, "lo", "blocks"]):
            roll = rolling(symbols)
            rows = [(i, b["step"], b["many"], b["core"], b["weight"]) for i, blocks in enumerate(lists) for b in blocks]
            g, step, many, core, weight = (np.array(x, np.int64) for x in zip(*rows))
            own = np.repeat(np.arange(len(many)), many)
            step = step[own] + np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many)
            g = g[own]
            at = begin[g] + step
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (k1[g], k2[g], lo[g] + step, weight[own].astype(np.int32), core[own],
                                       roll.of(at, at + size).view(np.int64))],
                names=["__k1", "__k2", "at", "weight", "core", "window"],
            )

    return run


def repeated_starts(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """``__k1, __k2, lo, hi``: runs of starts of repeated windows of ``size`` bytes (runs may touch, or come twice)."""
    texts = keyed(docs).select(*KEY, "text").where(F.octet_length("text") >= size)
    groups = arrow(texts, _groups(size, gram), _GROUP)
    shared = groups.groupBy("gram").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("gram")
    shared = store(shared, "op2-shared")  # a plain table, so that Spark can split the join where a bucket is hot
    groups = store(groups.join(shared, "gram", "left_semi"), "op2-groups")
    identity = ["gram", "c1", "c2"]
    contexts = groups.groupBy(*identity).agg(
        F.count(F.lit(1)).alias("weight"), F.min(F.struct(*KEY, "lo", "n", "off")).alias("first")
    )
    contexts = store(contexts, "op2-contexts")
    whole = groups.join(contexts.where("weight > 1").select(*identity), identity, "left_semi").select(
        *KEY, "lo", (F.col("lo") + F.col("n") - 1).alias("hi")
    )
    mixed = contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("gram")
    open_groups = (
        contexts.join(mixed, "gram", "left_semi")
        .select("first.*", "gram", F.least("weight", F.lit(2)).cast("int").alias("weight"))
        .groupBy(*KEY).agg(F.collect_list(F.struct("lo", "n", "off", "gram", "weight")).alias("groups"))
    )
    # Rows equal in id and text have one key: their groups weigh two or more, one of them is enough.
    own = store(arrow(texts.join(open_groups, KEY), _own_bytes(size), _SLICE), "op2-slices")
    blocks = arrow(own, _blocks(size), _BLOCK)
    identity = ["core", "full"]
    fulls = store(
        blocks.groupBy(*identity).agg(
            F.sum("weight").alias("weight"), F.min(F.struct(*KEY, "lo", "step", "many")).alias("first")
        ), "op2-blocks",
    )
    again = fulls.where("weight > 1").select(*identity)
    start = F.col("lo") + F.col("step")
    whole_blocks = blocks.where("weight = 1").join(again, identity, "left_semi").select(
        *KEY, start.alias("lo"), (start + F.col("many") - 1).alias("hi")
    )
    mixed = fulls.groupBy("core").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("core")
    open_blocks = (
        fulls.join(mixed, "core", "left_semi")
        .select("first.*", "core", F.least("weight", F.lit(2)).cast("int").alias("weight"))
        .groupBy(*KEY, "lo").agg(F.collect_list(F.struct("step", "many", "core", "weight")).alias("blocks"))
    )
    windows = store(
        arrow(own.select(*KEY, "lo", "bytes").join(open_blocks, [*KEY, "lo"]), _windows(size), _WINDOW), "op2-windows"
    )
    again = windows.groupBy("core", "window").agg(F.sum("weight").alias("_n")).where("_n > 1").select("core", "window")
    single = windows.where("weight = 1").join(again, ["core", "window"], "left_semi")
    single = single.select(*KEY, F.col("at").alias("lo"), F.col("at").alias("hi"))
    return whole.unionByName(whole_blocks).unionByName(single)


def _cut(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            texts, out = utf8(batch.column("text")), []
            for text, runs in zip(texts, batch.column("runs").to_pylist()):
                spans: list[list[int]] = []
                for lo, hi in sorted((r["lo"], r["hi"] + size) for r in runs or ()):
                    if spans and lo <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], hi)
                    else:
                        spans.append([lo, hi])
                edges = [0, *(x for s in spans for x in s), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(text), len(text) - len(kept), [{"start": a, "end": b} for a, b in spans], kept))
            n, removed, spans, kept = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "spans", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans`` (removed runs of bytes) and ``kept`` (the remaining bytes) per document."""
    runs = repeated_starts(docs, size, gram).groupBy(*KEY).agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    rows = keyed(docs).select(*KEY, F.col("doc_id").cast("long").alias("doc_id"), "text").join(runs, KEY, "left")
    schema = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"
    return arrow(rows.select("doc_id", "text", "runs"), _cut(size), schema)
