"""Operator 4, benchmark decontamination with item-sized SimHash windows and multi-index Hamming blocks.

1. *Shingles*: words ``[^\\x20\\x09-\\x0D]+`` in lower case; five words make a shingle (fewer words: all of them), hashed to 64 bits.
2. *Windows*: a window that is at least ``threshold`` similar to an item shares a shingle with it. Every shingle of every document is tested
   against a bit map of the benchmark's shingles (fixed size, no false negatives), then joined with them; a shingle at place ``p``
   that an item of ``n`` words has at place ``o`` asks for the window of ``n`` words from ``p - o``.
3. *SimHash* of each window and each item: a bit is set if more of the shingles, repeats included, have it than not.
4. *Multi-index blocks*: fingerprints are cut into ``RADIUS + 1`` blocks. Two fingerprints within ``RADIUS`` bits agree in a block, so a join
   on (words, block, value) finds all of them; the distance is checked next.
5. *Exact check*: weighted Jaccard similarity of the shingles, weights being the numbers of repeats: sum of minima over sum of maxima.

A document and an item are reported once, with the best window (ties: the earliest). Built-in functions only. Null and empty texts and
items have no words and never match. Rows equal in id and text share one result, a null ``doc_id`` is kept. Items with the same words
are each reported.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from penmark.llm.common import keyed, store

WORDS, THRESHOLD, RADIUS = 5, 0.8, 15
MAP_BITS = 22  # of the bit map: half a megabyte
KEY = ["__k1", "__k2"]
_NO_ID = -(1 << 63)  # stands for a null item_id while items are joined


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[\\x20\\x09-\\x0D]+"), "")


def _shingles(words: Column, size: Column | int) -> Column:
    """Hashes of all runs of ``size`` words (none if there are fewer)."""
    size = F.lit(size) if isinstance(size, int) else size
    last = F.size(words) - size + 1
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(words, i, size)))).otherwise(
        F.array().cast("array<long>")
    )


def _simhash(shingles: Column) -> Column:
    def bit(i: int) -> Column:
        ones = F.aggregate(shingles, F.lit(0), lambda n, h: n + F.shiftrightunsigned(h, i).bitwiseAND(F.lit(1)).cast("int"))
        return F.shiftleft((2 * ones > F.size(shingles)).cast("long"), i)

    return reduce(Column.bitwiseOR, [bit(i) for i in range(64)])


def _block(fp: Column, i: int, blocks: int) -> Column:
    low, high = 64 * i // blocks, 64 * (i + 1) // blocks
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1))


def _in_blocks(rows: DataFrame, radius: int) -> DataFrame:
    blocks = radius + 1
    values = [F.struct(F.lit(i).alias("block"), _block(F.col("fp"), i, blocks).alias("value")) for i in range(blocks)]
    return rows.withColumn("_b", F.explode(F.array(*values))).select(*rows.columns, "_b.block", "_b.value")


def weighted_jaccard(a: Column, b: Column) -> Column:
    """Similarity of two non-empty arrays as multisets."""
    def times(array: Column, x: Column) -> Column:
        return F.size(F.filter(array, lambda y: y == x))

    both = F.aggregate(F.array_distinct(a), F.lit(0), lambda n, x: n + F.least(times(a, x), times(b, x)))
    return both / (F.size(a) + F.size(b) - both)


def _items(benchmark: DataFrame, words: int) -> DataFrame:
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("long"), F.lit(_NO_ID)).alias("item_id"), _words(F.col("text")).alias("w")).where(F.size("w") > 0)
    rows = rows.withColumns({"n": F.size("w"), "k": F.least(F.size("w"), F.lit(words))})
    return rows.select("item_id", "n", "k", _shingles(F.col("w"), F.col("k")).alias("shingles"))


def _bit_map(grams: DataFrame) -> DataFrame:
    """One row, one array of longs: the bits of the shingles' low ``MAP_BITS``."""
    cell = F.col("shingle").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    bits = grams.select(F.shiftright(cell, 6).alias("at"), F.call_function("shiftleft", F.lit(1).cast("long"), cell.bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
    filled = bits.groupBy("at").agg(F.bit_or("bit").alias("bits"))
    every = grams.sparkSession.range(1 << (MAP_BITS - 6)).withColumnRenamed("id", "at")
    listed = F.array_sort(F.collect_list(F.struct("at", F.coalesce("bits", F.lit(0)).alias("bits"))))
    return every.join(filled, "at", "left").agg(F.transform(listed, lambda x: x["bits"]).alias("bits"))


def matches(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``__k1, __k2, item_id, start, n_words, hamming, similarity``: see the module. ``start`` is in words, from 0."""
    items = store(_items(benchmark, words), "op4-items")
    grams = items.select("n", "k", F.posexplode("shingles").alias("o", "shingle")).distinct()
    bits = store(_bit_map(grams), "op4-bits").scalar()
    texts = keyed(docs).select(*KEY, "text").where(F.octet_length("text") > 0)
    split = texts.select(*KEY, _words(F.col("text")).alias("w"))
    hits = []
    for k in [r["k"] for r in items.select("k").distinct().collect()]:  # five at most, usually the one value 5
        at = split.select(*KEY, F.size("w").alias("total"), F.posexplode(_shingles(F.col("w"), k)).alias("p", "shingle"))
        cell = F.col("shingle").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
        word = F.get(bits, F.shiftright(cell, 6).cast("int"))
        seen = at.where(F.call_function("shiftright", word, cell.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1)
        hits.append(seen.join(grams.where(F.col("k") == k), "shingle"))
    if not hits:
        hits = [texts.where("false").select(*KEY, F.lit(0).alias("total"), F.lit(0).alias("p"), F.lit(0).alias("o"), F.lit(0).alias("n"), F.lit(0).alias("k"))]
    hits = reduce(DataFrame.unionByName, [h.select(*KEY, "total", "p", "o", "n", "k") for h in hits])
    start = F.greatest(F.lit(0), F.least(F.col("p") - F.col("o"), F.col("total") - F.col("n")))
    wanted = store(hits.select(*KEY, start.alias("start"), "n", "k").distinct(), "op4-windows")
    per_text = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("start", "n", "k")).alias("wanted"))
    cut = texts.join(per_text, KEY).select(*KEY, _words(F.col("text")).alias("w"), F.explode("wanted").alias("x"))
    windows = cut.select(*KEY, "x.start", "x.n", _shingles(F.slice("w", F.col("x.start") + 1, F.col("x.n")), F.col("x.k")).alias("shingles"))
    windows = store(windows.where(F.size("shingles") > 0).withColumn("fp", _simhash(F.col("shingles"))), "op4-fingerprints")
    marked = store(items.withColumn("fp", _simhash(F.col("shingles"))), "op4-marked")
    near = _in_blocks(windows.select(*KEY, "start", "n", "fp"), radius).join(
        _in_blocks(marked.select("item_id", "n", "fp"), radius)
        .withColumnRenamed("fp", "item_fp"), ["n", "block", "value"]
    )
    near = near.withColumn("hamming", F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))).where(F.col("hamming") <= radius)
    near = near.select(*KEY, "start", "n", "item_id", "hamming").distinct()
    pairs = near.join(windows.select(*KEY, "start", "n", "shingles").dropDuplicates([*KEY, "start", "n"]), [*KEY, "start", "n"])
    pairs = pairs.join(marked.select("item_id", "n", F.col("shingles").alias("item")).distinct(), ["item_id", "n"])
    found = pairs.withColumn("similarity", weighted_jaccard(F.col("shingles"), F.col("item"))).where(F.col("similarity") >= threshold)
    best = F.max_by(F.struct("start", F.col("n").alias("n_words"), "hamming", "similarity"), F.struct("similarity", -F.col("start")))
    return found.groupBy(*KEY, "item_id").agg(best.alias("_x")).select(
        *KEY, F.nullif(F.col("item_id"), F.lit(_NO_ID)).alias("item_id"), "_x.*")


def leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, item_id, start, n_words, hamming, similarity`` of every document that holds an item."""
    found = matches(docs, benchmark, **options)
    ids = keyed(docs).select(*KEY, F.col("doc_id").cast("long").alias("doc_id")).distinct()
    return found.join(ids, KEY).drop(*KEY)


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    found = store(matches(docs, benchmark, **options).select(*KEY).distinct(), "op4-found")
    return keyed(docs).join(found, KEY, "left_anti").select(*docs.columns)
