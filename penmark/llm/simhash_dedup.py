"""Operator 10, SimHash near-duplicates with a segment-popcount embedding.

1. *Fingerprints*: words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case, shingles of ``words`` words, the XXH64 (seed 42) of
   every shingle, repeats included; a bit is 1 if it is set in over half of the hashes. Null, empty and blank texts have 0.
2. *Classes*: rows with one fingerprint are one class from here on, so a group of copies is one row.
3. *Embedding*: the bits set in each of 32 segments of two bits make a point of a grid. The Manhattan distance of two points is never
   more than the Hamming distance of the fingerprints, so links (two bits or fewer) lie within two steps of each other.
4. *Range join*: two points within two steps have a grid point within one step of both. Every fingerprint is put on its grid point and
   the up to 64 around it. Those that meet on a grid point are within two steps of each other: they are the candidates.
5. *Exact check*: the candidates of a grid point with at most ``CELL`` fingerprints are compared pair by pair and linked if they differ in
   two bits or fewer.
6. *Hot grid points* list no pairs. Two fingerprints differ in two bits or fewer exactly if one flipped bit (or none) in each makes them
   equal. The fingerprints of such a point are put on their 65 such values; all that meet on a value are linked to the smallest there.
7. *Components* over classes, then the smallest ``doc_id`` of each.

Rows: about 49 for each distinct fingerprint, of which only those that met another are kept; 65 more for each on a hot grid point. Pairs are
at most ``CELL / 2`` for each place of a fingerprint. A null ``doc_id`` takes part and never names a component if there is another id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from penmark.llm.common import arrow, keyed, slices, store, utf8
from penmark.llm.components import components

WORDS, SEED, SEGMENTS = 3, 42, 32
MAX_BITS = 2
CELL = 16  # fingerprints of a grid point that are compared pair by pair; more are linked by flipped bits


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Signed 64-bit fingerprint of one text."""
    found = text.lower().split()
    if not found:
        return 0
    hash_of = xxhash.xxh64_intdigest
    if len(found) <= words:
        hashes = [hash_of(b" ".join(found), SEED)]
    else:
        line = b" ".join(found)
        ends = np.cumsum([len(w) + 1 for w in found]) - 1
        starts = (ends - [len(w) for w in found]).tolist()
        hashes = [hash_of(line[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist())]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes, as a signed number."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[at : at + (1 << 16)], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``__k1, __k2, doc_id, fp``: the key and the 64-bit fingerprint (signed) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            found = [fingerprint(t, words) for t in utf8(batch.column("text"))]
            own = [batch.column(c) for c in ("__k1", "__k2", "doc_id")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(found, pa.int64())], names=["__k1", "__k2", "doc_id", "fp"])

    rows = keyed(docs).select("__k1", "__k2", F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow(rows, run, "__k1 long, __k2 long, doc_id long, fp long")


_LOW = 0x5555555555555555  # the lower bit of every field


def _points(prints: DataFrame) -> DataFrame:
    """``fp, point``: the grid point of each ``fp`` and those one step away, as one number with a field of two bits for each segment of two.

    The counts of all segments are made at once: the field's upper bit if both are set, its lower bit if one is. A step up or down is
    a change of the field by one or by three in binary."""
    next_ = F.shiftrightunsigned("fp", 1)
    both, one = F.col("fp").bitwiseAND(next_).bitwiseAND(F.lit(_LOW)), F.col("fp").bitwiseXOR(next_).bitwiseAND(F.lit(_LOW))
    own = prints.select("fp", F.shiftleft(both, 1).bitwiseOR(one).alias("_own"))  # a column, so that it is made once

    def moved(i: int, by: int) -> Column:
        """The own point with the field changed, where its count allows."""
        count = F.shiftrightunsigned("_own", 2 * i).bitwiseAND(F.lit(3))
        allowed = count <= 1 if by == 1 else count >= 1
        return F.when(allowed, F.col("_own").bitwiseXOR(F.lit(_signed(by << 2 * i))))

    around = [moved(i, by) for i in range(SEGMENTS) for by in (1, 3)]
    return own.select("fp", F.explode(F.array("_own", *around)).alias("point")).where("point IS NOT NULL")


def links(prints: DataFrame, cell: int = CELL, bits: int = MAX_BITS) -> DataFrame:
    """``a, b``: links between distinct fingerprints that differ in one or two bits, enough to join what is connected.

    With more ``bits``, also pairs that differ in so many and meet on a grid point that is not hot: candidates of a check that follows."""
    points = _points(prints)
    met = points.groupBy("point").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    placed = store(points.join(met.hint("merge"), "point"), "op10-placed")
    few = placed.where(F.col("size") <= cell).groupBy("point").agg(F.collect_list("fp").alias("fps"))
    close = F.filter("fps", lambda b: (b < F.col("a")) & (F.bit_count(F.col("a").bitwiseXOR(b)) <= bits))
    near = few.select(F.explode("fps").alias("a"), "fps").select("a", F.explode(close).alias("b"))
    return near.unionByName(_flipped(placed.where(F.col("size") > cell).select("fp").distinct())).distinct()


def _flipped(prints: DataFrame) -> DataFrame:
    """Links as above without listing pairs: each fingerprint to the smallest that one flipped bit, or none, in each makes equal."""
    flips = [F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64))]
    values = store(prints, "op10-hot").select("fp", F.explode(F.array(*flips)).alias("value"))
    least = values.groupBy("value").agg(F.min("fp").alias("b"), F.max("fp").alias("y")).where("b < y").select("value", "b")
    return values.join(least.hint("merge"), "value").where("fp <> b").select(F.col("fp").alias("a"), "b")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``__k1, __k2, doc_id, fp, component_id`` for every row: the smallest ``doc_id`` reachable over links of two bits or fewer, and
    ``stays``: whether the row's key is the smallest of its component."""
    rows = store(fingerprints(docs, words), "op10-fingerprints")
    classes = store(rows.groupBy("fp").agg(F.min(F.struct("__k1", "__k2", "doc_id")).alias("first")), "op10-classes")
    joined = components(links(classes.select("fp")))
    root = classes.join(joined.select(F.col("a").alias("fp"), F.col("b").alias("_root")), "fp", "left").select(
        "fp", F.coalesce("_root", "fp").alias("_root"), "first"
    )
    named = root.groupBy("_root").agg(F.min("first").alias("first"))
    of_class = store(root.select("fp", "_root").join(named, "_root").select("fp", "first"), "op10-names")
    stays = (F.col("__k1") == F.col("first.__k1")) & (F.col("__k2") == F.col("first.__k2"))
    return rows.join(of_class, "fp").select(
        "__k1", "__k2", "doc_id", "fp", F.col("first.doc_id").alias("component_id"), stays.alias("stays")
    )


def keep_one(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One row of every component (the smallest ``doc_id``; among rows equal in id and text any), with all columns of ``docs``."""
    kept = near_duplicates(docs, words).where("stays").select("__k1", "__k2").distinct()
    rows = keyed(docs).join(kept, ["__k1", "__k2"], "left_semi")
    return rows.dropDuplicates(["__k1", "__k2"]).select(*docs.columns)
