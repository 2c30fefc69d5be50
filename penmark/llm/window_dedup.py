"""Operator 8, substring dedup with a count-min prefilter.

A window is ``size`` consecutive words of one document. Every window has an anchor, a gram of ``gram`` words (see :mod:`common`), and
a gram starts at least as often as any window anchored in it. Pass one counts the anchors of every partition in a count-min sketch;
the sketches are merged in Spark (two levels, so no task holds more than the root of all of them) into one of fixed size, which is
broadcast. Its estimates are never below the number of equal windows. Pass two keeps the groups of windows whose estimate is two
or more, which loses no repeated window, and groups exactly:

* by *context* (all words of a group's windows): where a smaller document has the same context, every window is repeated. A context of more than
  one in ``HOT`` groups (there are fewer than ``HOT``) is looked up where its groups are, and neighbouring groups become one run;
* within an anchor's bucket that holds several contexts, window by window, each context once.

Identifiers have 128 bits. Hot windows are counted with partial aggregations and joined back; no group meets in one task.

The sketch takes ``DEPTH * 2**BITS`` bytes whatever the input. On inputs far above ``2**BITS`` anchors it lets more through, which costs
time in pass two and changes no result.

Null and empty texts have no words. A null ``doc_id`` counts as larger than any other; equal ids do not repeat each other. Further
columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from penmark.llm.common import (
    anchor_groups, arrow, chunks, keyed, mix, rolling, slices, store, utf8, words_of,
)

SIZE, GRAM = 50, 20
BITS, DEPTH = 24, 3
HOT = 1000
_BLOCK = 1 << 16  # cells of a block of the sketch
KEY = ["__k1", "__k2"]
CONTEXT = ["gram", "c1", "c2"]
_GROUP = "__k1 long, __k2 long, lo long, n int, off int, gram long, c1 long, c2 long"


def _anchors(batch: pa.RecordBatch, size: int, gram: int) -> Iterator[tuple[np.ndarray, dict[str, np.ndarray]]]:
    """Row and groups (``lo`` in words of the text) of every chunk of a batch."""
    symbols, counts = words_of(utf8(batch.column("text")))
    begin = np.cumsum(counts) - counts
    for parts in chunks(counts, size):
        rows, starts, ends = map(np.array, zip(*parts))
        stop = np.cumsum(ends - starts)
        g = anchor_groups(np.concatenate([symbols[begin[r] + a : begin[r] + b] for r, a, b in parts]), stop, size, gram)
        at = g["part"]
        g["lo"] = g["lo"] - np.concatenate(([0], stop[:-1]))[at] + starts[at]
        yield rows[at], g


def _cells(grams: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(grams.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (row + 1) & (1 << 64) - 1)) >> np.uint64(64 - bits)).astype(np.int64)


def _sketch(size: int, gram: int, bits: int, depth: int):
    """The sketch of a partition: per block the cells counted, those of two and more twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(depth << bits, np.uint8)
        for batch in (s for b in batches for s in slices(b)):
            for _, g in _anchors(batch, size, gram):
                for row in range(depth):
                    cells, n = np.unique(_cells(g["gram"], row, bits), return_counts=True)
                    cells += row << bits
                    table[cells] = np.minimum(2, table[cells] + np.minimum(n, 2))
        block = min(_BLOCK, 1 << bits)
        for b in range(len(table) // block):
            part = table[b * block : (b + 1) * block]
            once, twice = (np.flatnonzero(part == k).astype(np.uint16) for k in (1, 2))
            if len(once) + len(twice):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), pa.array([once.tobytes()]), pa.array([twice.tobytes()])], names=["block", "once", "twice"]
                )

    return run


def _merge(block: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        cells = np.zeros(block, np.int64)
        for once, twice in zip(pdf["once"], pdf["twice"]):
            cells[np.frombuffer(once, np.uint16)] += 1
            cells[np.frombuffer(twice, np.uint16)] += 2
        once, twice = np.flatnonzero(cells == 1).astype(np.uint16), np.flatnonzero(cells > 1).astype(np.uint16)
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "once": [once.tobytes()], "twice": [twice.tobytes()]})

    return run


def merged_sketch(texts: DataFrame, size: int, gram: int, bits: int, depth: int) -> Broadcast:
    """True where a cell was counted twice or more: ``depth`` rows of ``2**bits``."""
    schema = "block int, once binary, twice binary"
    parts = arrow(texts.select("text"), _sketch(size, gram, bits, depth), schema)
    root = math.isqrt(max(1, texts.sparkSession.sparkContext.defaultParallelism)) * 8
    block = min(_BLOCK, 1 << bits)
    merge = _merge(block)
    parts = parts.withColumn("part", F.spark_partition_id() % root).groupBy("block", "part").applyInPandas(merge, schema)
    parts = parts.groupBy("block").applyInPandas(merge, schema)
    repeated = np.zeros(depth << bits, bool)
    for row in parts.select("block", "twice").toLocalIterator():
        repeated[row["block"] * block + np.frombuffer(row["twice"], np.uint16).astype(np.int64)] = True
    return texts.sparkSession.sparkContext.broadcast(np.packbits(repeated))


def _candidates(size: int, gram: int, bits: int, depth: int, sketch: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated = sketch.value
        for batch in (s for b in batches for s in slices(b)):
            k1, k2 = (batch.column(k).to_numpy() for k in KEY)
            for row, g in _anchors(batch, size, gram):
                keep = np.ones(len(row), bool)
                for r in range(depth):
                    cell = _cells(g["gram"], r, bits) + (r << bits)
                    keep &= (repeated[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool)
                g = {k: v[keep] for k, v in g.items()}
                row = row[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (k1[row], k2[row], g["lo"], g["n"].astype(np.int32), g["off"].astype(np.int32),
                                           g["gram"], g["c1"], g["c2"])],
                    names=["__k1", "__k2", "lo", "n", "off", *CONTEXT],
                )

    return run


def _split_hot(hot: list[tuple[int, int, int, int]], runs: bool):
    """``hot`` has contexts with their smallest document. Groups of such a context in a larger document: the runs of starts they make
    (``runs``), or all groups but these."""
    gram, c1, c2, first = np.array(sorted(hot, key=lambda h: h[1]), np.int64).reshape(-1, 4).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {c: batch.column(c).to_numpy() for c in batch.schema.names}
            at = np.minimum(np.searchsorted(c1, column["c1"]), len(c1) - 1)
            same = (c1[at] == column["c1"]) & (c2[at] == column["c2"]) & (gram[at] == column["gram"])
            settled = same & (column["__k1"] > first[at])
            if not runs:
                yield batch.filter(pa.array(~settled))
                continue
            k1, k2, lo, n = (column[c][settled] for c in (*KEY, "lo", "n"))
            if len(lo):
                apart = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (lo[1:] != lo[:-1] + n[:-1])
                heads, tails = np.append(True, apart), np.append(apart, True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (k1[heads], k2[heads], lo[heads], (lo + n - 1)[tails])], names=["__k1", "__k2", "lo", "hi"])

    return run


def _windows(size: int):
    """Identifiers of the windows of the groups listed with each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            symbols, counts = words_of(utf8(batch.column("text")))
            begin = np.cumsum(counts) - counts
            rows, found = [], []
            for start, first, groups in zip(begin, batch.column("__k1").to_pylist(), batch.column("groups").to_pylist()):
                for g in groups:
                    at = start + g["lo"]
                    roll = rolling(symbols[at : at + g["n"] - 1 + size])
                    rows.append((first, g["gram"], g["c1"], g["c2"]))
                    found.append(roll.all(size).view(np.int64))
            if rows:
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x, pa.int64()) for x in zip(*rows)), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))],
                    names=["first", *CONTEXT, "windows"],
                )

    return run


def repeated_starts(docs: DataFrame, size: int = SIZE, gram: int = GRAM, bits: int = BITS, depth: int = DEPTH) -> DataFrame:
    """``__k1, __k2, lo, hi``: runs of window starts (in words) whose windows also start in a document with a smaller id."""
    texts = keyed(docs).select(*KEY, "text").where(F.octet_length("text") >= 2 * size - 1)
    sketch = merged_sketch(texts, size, gram, bits, depth)
    groups = store(arrow(texts, _candidates(size, gram, bits, depth, sketch), _GROUP), "op8-groups")
    contexts = groups.groupBy(*CONTEXT).agg(
        F.min(F.struct(*KEY, "lo", "n", "off")).alias("first"), F.max("__k1").alias("last"), F.count(F.lit(1)).alias("times"))
    contexts = store(contexts, "op8-contexts")
    total = contexts.agg(F.sum("times")).first()[0] or 0
    hot = contexts.where("first.__k1 < last").where(F.col("times") * HOT > total).select(*CONTEXT, "first.__k1").collect()
    mixed = (
        contexts.groupBy("gram").agg(F.min("first.__k1").alias("a"), F.max("first.__k1").alias("b")).where("a < b").select("gram")
    )
    mixed = store(mixed, "op8-mixed")  # a plain table, so that Spark can split the join where a bucket is hot
    open_groups = contexts.join(mixed, "gram", "left_semi").select("first.*", *CONTEXT).groupBy(*KEY).agg(
        F.collect_list(F.struct("lo", "n", "off", *CONTEXT)).alias("groups")
    )
    # Rows equal in id and text would list a context once each: one of them is enough.
    reps = texts.join(open_groups, KEY)
    windows = store(
        arrow(reps, _windows(size), "first long, gram long, c1 long, c2 long, windows array<long>"), "op8-windows"
    ).select("first", *CONTEXT, F.posexplode("windows").alias("step", "window"))
    earliest = windows.groupBy("gram", "window").agg(F.min("first").alias("a"), F.max("first").alias("b")).where("a < b")
    earliest = store(earliest, "op8-earliest")
    partial = (
        windows.join(earliest.select("gram", "window", "a"), ["gram", "window"]).where("a < first")
        .groupBy(*CONTEXT).agg(F.collect_set("step").alias("steps"))
    )
    rest = arrow(groups, _split_hot(hot, runs=False), _GROUP) if hot else groups
    marked = rest.join(contexts.select(*CONTEXT, F.col("first.__k1").alias("first")), CONTEXT)
    last = F.col("lo") + F.col("n") - 1
    whole = marked.where("__k1 > first").select(*KEY, "lo", last.alias("hi"))
    some = marked.where("__k1 = first").join(partial, CONTEXT).select(*KEY, "lo", F.explode("steps").alias("step"))
    at = F.col("lo") + F.col("step")
    found = whole.unionByName(some.select(*KEY, at.alias("lo"), at.alias("hi")))
    return found.unionByName(arrow(groups, _split_hot(hot, runs=True), "__k1 long, __k2 long, lo long, hi long")) if hot else found


def _cut(size: int, rewrite: bool = False):
    """Cut the listed windows out of every text. ``rewrite``: give the rows with their new text instead of a report."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            out = []
            for text, runs in zip(utf8(batch.column("text")), batch.column("__runs").to_pylist()):
                words = text.split()
                spans: list[list[int]] = []
                for lo, hi in sorted((r["lo"], r["hi"] + size) for r in runs or ()):
                    if spans and lo <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], hi)
                    else:
                        spans.append([lo, hi])
                edges = [0, *(x for s in spans for x in s), len(words)]
                kept = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
                out.append((len(words), len(words) - len(kept), [{"start": a, "end": b} for a, b in spans], b" ".join(kept)))
            n, removed, spans, kept = zip(*out)
            if rewrite:
                text = [t if not gone else k.decode() for t, gone, k in zip(batch.column("text").to_pylist(), removed, kept)]
                columns = {k: batch.column(k) for k in batch.schema.names if k != "__runs"} | {"text": pa.array(text, pa.string())}
                rest = pa.array([not gone or bool(k) for gone, k in zip(removed, kept)])
                yield pa.RecordBatch.from_pydict(columns).filter(rest)
                continue
            given = [batch.column(i) for i, name in enumerate(batch.schema.names) if name not in ("text", "__runs")]
            yield pa.RecordBatch.from_arrays(
                [*given, pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                names=[*(x for x in batch.schema.names if x not in ("text", "__runs")), "n_words", "n_removed", "spans", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, size: int = SIZE, gram: int = GRAM, bits: int = BITS, depth: int = DEPTH) -> DataFrame:
    """``doc_id, n_words, n_removed, spans`` (removed runs of words) and ``kept`` (UTF-8 of the kept words, one space between)."""
    runs = repeated_starts(docs, size, gram, bits, depth).groupBy(*KEY).agg(F.collect_list(F.struct("lo", "hi")).alias("__runs"))
    rows = keyed(docs).select(*KEY, F.col("doc_id").cast("long").alias("doc_id"), "text").join(runs, KEY, "left")
    schema = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"
    return arrow(rows.select("doc_id", "text", "__runs"), _cut(size), schema)


def rewrite(docs: DataFrame, size: int = SIZE, gram: int = GRAM, bits: int = BITS, depth: int = DEPTH) -> DataFrame:
    """``docs`` with the repeated words cut from ``text`` (other texts unchanged, byte for byte). Rows of which nothing stays are left out."""
    runs = repeated_starts(docs, size, gram, bits, depth).groupBy(*KEY).agg(F.collect_list(F.struct("lo", "hi")).alias("__runs"))
    rows = keyed(docs).join(runs, KEY, "left").select(*docs.columns, "__runs")
    return arrow(rows, _cut(size, rewrite=True), docs.schema)
