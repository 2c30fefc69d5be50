"""Operator 1, packing by cutting-stock column generation.

Every document becomes token ids, closed by ``end_id``. Runs of ``capacity`` ids fill sequences of their own; what is left of each
document (one piece, never cut) is packed by a cutting-stock plan:

1. Pieces are counted by length class (lengths rounded up to ``grid``), one partial aggregation: at most ``capacity / grid`` numbers.
2. The linear program over patterns (how many pieces of each class share a sequence) is solved by column generation: revised simplex,
   new patterns priced by an unbounded-knapsack dynamic program over the dual values. It sees the histogram only, so its cost does
   not depend on the number of documents.
3. Pattern counts are rounded down; the few pieces left per class (fewer than one per pattern) are packed by first fit, longest first.
4. In each class documents are ranked by a hash of their id; ranks are mapped to sequences by arithmetic on the pattern counts. Ranks
   come from counts of (class, bucket of the hash): a class that holds a third of all pieces is spread over all buckets.

Offsets inside a sequence follow from a running sum over its pieces (at most ``capacity`` of them).

Null text is empty (one id, the end). Rows equal in id and text are separate documents. A null ``doc_id`` stays null. Further columns are
ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from penmark.llm.common import arrow, slices, store

CAPACITY, END_ID, GRID = 2048, 1, 16
CACHE = 100_000  # words whose ids a worker remembers
BUCKET_ROWS = 2048
NEAR = 0.001
_UNEVEN = re.compile(r"\s | \s")
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value: byte-level BPE


class WordEncoder:
    """Token ids as little-endian unsigned 32-bit bytes, for a byte-level BPE in a tokenizers file.

    The split rule of byte-level BPE always cuts before a single space, so words with their leading space can be encoded one by
    one and remembered. Texts where white space meets white space, or that hold a special token, are encoded as a whole.
    """

    def __init__(self, path: str):
        import tiktoken

        data = json.load(open(path, encoding="utf-8"))
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in printable}
        letters |= {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in printable)}
        special = {x["content"] for x in data["added_tokens"]}
        ranks = {bytes(letters[c] for c in t): i for t, i in data["model"]["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding("words", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.path = path
        self.special = special
        self.known: dict[str, bytes] = {}

    @cached_property
    def whole(self):
        """The tokenizer itself, loaded by the first text that holds a special token."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _new(self, word: str) -> bytes:
        ids = np.array(self.fast.encode_ordinary(word), "<u4").tobytes()
        if len(self.known) < CACHE and len(word) < 64:
            self.known[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if _UNEVEN.search(text):
            return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        words = text.replace(" ", "\0 ").split("\0") if "\0" not in text else [text]
        known = self.known.get
        return b"".join([known(w) or self._new(w) for w in words])


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, order`` and, on request, ``ids`` (32-bit little-endian)."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).ids
        for batch in (s for b in batches for s in slices(b)):
            out = []
            for doc, key, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "order", "text"))):
                ids = encode(text or "") + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    out.append((doc, key, start, len(part) // 4, zlib.crc32(part), total, part if keep_ids else None))
            columns = [pa.array(x, f.type) for x, f in zip(zip(*out), schema)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    names = {"doc_id": pa.int64(), "order": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(),
             "doc_tokens": pa.int64(), "ids": pa.binary()}
    schema = pa.schema(list(names.items()))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", F.lit(7)).alias("order"), "text")
    return arrow(rows, run, ", ".join(f"{k} {'binary' if t == pa.binary() else 'long'}" for k, t in names.items()))


def _best_pattern(sizes: np.ndarray, values: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of classes within ``room`` grid steps; class ``i`` takes ``sizes[i]`` (ascending, distinct)."""
    best = np.zeros(room + 1)
    took = np.full(room + 1, -1)
    for c in range(1, room + 1):
        n = np.searchsorted(sizes, c, side="right")
        if n:
            found = best[c - sizes[:n]] + values[:n]
            i = int(found.argmax())
            best[c], took[c] = found[i], i
        if best[c - 1] >= best[c]:
            best[c], took[c] = best[c - 1], -1
    pattern, c = np.zeros(len(sizes)), room
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            pattern[took[c]] += 1
            c -= sizes[took[c]]
    return float(best[room]), pattern


def _inverted(basis: np.ndarray) -> np.ndarray:
    """Gauss-Jordan, one pivot column at a time: element-wise arithmetic only, so that no threaded linear algebra runs on the driver."""
    m = len(basis)
    both = np.hstack([basis, np.eye(m)])
    for k in range(m):
        pivot = k + int(np.abs(both[k:, k]).argmax())
        both[[k, pivot]] = both[[pivot, k]]
        both[k] /= both[k, k]
        factor = both[:, k].copy()
        factor[k] = 0
        both -= factor[:, None] * both[k]
    return both[:, m:]


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    return (matrix * vector).sum(axis=1)


def solve(sizes: np.ndarray, demand: np.ndarray, room: int, rounds: int = 5000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and their fractional counts that cover ``demand`` with the fewest sequences.

    Revised simplex over a basis of one pattern per class, beginning with patterns of one class each. The best pattern's worth at the
    dual prices bounds the distance to the optimum, so it ends within ``NEAR`` of it.
    """
    m = len(sizes)
    basis = np.diag((room // sizes).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    counts = _times(inverse, demand)
    for step in range(rounds):
        worth, pattern = _best_pattern(sizes, inverse.sum(axis=0), room)
        if worth <= 1 + NEAR:
            break
        way = _times(inverse, pattern)
        ratio = np.where(way > 1e-9, counts / np.where(way > 1e-9, way, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = pattern
        row = inverse[out] / way[out]
        inverse = inverse - way[:, None] * row
        inverse[out] = row
        if step % 100 == 99:
            inverse = _inverted(basis)
        counts = np.maximum(_times(inverse, demand), 0)
    assert m == basis.shape[1]
    return basis.astype(np.int64), counts


def plan(histogram: dict[int, int], capacity: int = CAPACITY, grid: int = GRID) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Where the ranks of each class go: ``(class, from_rank, to_rank, per_sequence, first_sequence)``, and the number of sequences.

    Ranks of an interval fill consecutive sequences, ``per_sequence`` each.
    """
    if not histogram:
        return [], 0
    sizes = np.array(sorted(histogram))
    left = np.array([histogram[s] for s in sizes], np.int64)
    room = capacity // grid
    patterns, counts = solve(sizes, left.astype(float), room)
    used, out, sequence = np.zeros(len(sizes), np.int64), [], 0

    def place(pattern: np.ndarray, times: int) -> None:
        nonlocal sequence
        for i in np.flatnonzero(pattern):
            out.append((int(sizes[i]), int(used[i]), int(used[i] + pattern[i] * times), int(pattern[i]), sequence))
            used[i] += pattern[i] * times
        sequence += times

    for pattern, count in zip(patterns.T, np.floor(counts + 1e-9).astype(np.int64)):
        held = np.flatnonzero(pattern)
        times = int(min(count, *((left[held] - used[held]) // pattern[held]))) if len(held) else 0
        if times > 0:
            place(pattern, times)
    while (used < left).any():  # first fit, longest first, whole patterns at once
        pattern, free = np.zeros(len(sizes), np.int64), room
        for i in np.flatnonzero(used < left)[::-1]:
            pattern[i] = min(left[i] - used[i], free // sizes[i])
            free -= pattern[i] * sizes[i]
        held = np.flatnonzero(pattern)
        place(pattern, int(((left[held] - used[held]) // pattern[held]).min()))
    return out, sequence


def _before(by: list[str], order: list[str], what: str) -> Column:
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(what).over(window), F.lit(0))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, grid: int = GRID, keep_ids: bool = True) -> DataFrame:
    """Pieces with their ``sequence_id`` and ``offset``: a sequence is the ids of its pieces in order of offset."""
    spark = docs.sparkSession
    rows = store(pieces(docs, tokenizer, capacity, end_id, keep_ids), "op1-pieces")
    total = rows.count()
    buckets = max(64, -(-total // BUCKET_ROWS))
    kind = F.when(F.col("length") == capacity, 0).otherwise(F.ceil(F.col("length") / grid)).cast("int")
    rows = rows.withColumns({"kind": kind, "bucket": F.pmod(F.xxhash64("order", "start", "ids_crc32"), F.lit(buckets))})
    sizes = store(rows.groupBy("kind", "bucket").agg(F.count(F.lit(1)).alias("n")), "op1-sizes")
    histogram = {r["kind"]: r["n"] for r in sizes.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    full = histogram.pop(0, 0)
    where, used = plan(histogram, capacity, grid)
    spans = spark.createDataFrame(
        [*((k, a, b, p, s) for k, a, b, p, s in where), (0, 0, full, 1, used)],
        "kind int, from_rank long, to_rank long, per_sequence long, first_sequence long",
    )
    first = sizes.select("kind", "bucket", _before(["kind"], ["bucket"], "n").alias("first"))
    inside = Window.partitionBy("kind", "bucket").orderBy("order", "start", "doc_tokens", "ids_crc32")
    ranked = rows.drop("ids").withColumn("rank", F.row_number().over(inside) - 1).join(first, ["kind", "bucket"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("first"))
    # At most one row per class and pattern: a few thousand, whatever the number of documents.
    placed = ranked.join(F.broadcast(spans), "kind").where("rank >= from_rank AND rank < to_rank")
    sequence = F.col("first_sequence") + F.floor((F.col("rank") - F.col("from_rank")) / F.col("per_sequence"))
    placed = placed.withColumn("sequence_id", sequence.cast("long"))
    placed = placed.withColumn("offset", _before(["sequence_id"], ["kind", "rank"], "length"))
    out = placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    if not keep_ids:
        return out
    same = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    number = Window.partitionBy(*same).orderBy(F.lit(0))
    a, b = (x.withColumn("copy", F.row_number().over(number)) for x in (out, rows.select(*same, "ids")))
    keys = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*same, "copy"]]
    return a.alias("a").join(b.alias("b"), keys).select("a.*", "b.ids").drop("copy")
