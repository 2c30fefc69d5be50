"""Operator 12, periodic runs by descending-LCP Kruskal.

A run is a stretch of consecutive words with smallest period ``q`` that cannot be extended on either side. Texts are independent, so every
task works on whole texts of its own:

1. *Suffix classes*: words become numbers; positions are ranked by their next 1, 2, 4, ... words (only classes that still have several members
   are refined). Neighbours in the final order have a longest common prefix (LCP), read off the kept ranks.
2. *Kruskal*: neighbours are united by decreasing LCP with union-find; each class keeps its positions in order. When a union puts two positions
   side by side at a distance ``d`` of at most the LCP ``l``, the words from the first position on repeat with period ``d`` over ``d + l`` words.
   No position of the class lies between them, so ``d`` is the smallest period, and ``l`` is exact, so the stretch ends there; it is a run if
   the word before breaks the period. Every run arises this way, at its own first word.
3. A run of at least ``least`` words and ``times`` periods has an LCP of at least ``least - q`` and ``(times - 1) * q``; LCPs too short for any
   ``q`` cannot seed one and are not united.

Null and empty texts have no words and no runs. A null ``doc_id`` plants nothing (see :func:`planted`). Rows are independent: ties, repeated rows
and extra columns change nothing. Memory of a task is proportional to ``SLICE`` bytes of text or to its longest text.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from penmark.llm.common import arrow, slices, utf8

LEAST, TIMES, EVERY = 24, 3, 10
SLICE = 2 << 20
LOAD = 1024  # positions in one block of an ordered set
FIELDS = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


class Places:
    """An ordered set of positions in blocks, so that an insertion moves at most ``2 * LOAD`` of them."""

    __slots__ = ("blocks", "firsts", "size")

    def __init__(self, first: int):
        self.blocks, self.firsts, self.size = [[first]], [first], 1

    def insert(self, x: int) -> tuple[int, int]:
        """Add ``x``; the positions before and after it, -1 where there is none."""
        at = max(0, bisect_left(self.firsts, x) - 1)
        block = self.blocks[at]
        i = bisect_left(block, x)
        before = block[i - 1] if i else -1
        if i < len(block):
            after = block[i]
        else:
            after = self.firsts[at + 1] if at + 1 < len(self.firsts) else -1
        block.insert(i, x)
        if not i:
            self.firsts[at] = x
        self.size += 1
        if len(block) > 2 * LOAD:
            self.blocks[at : at + 1] = [block[:LOAD], block[LOAD:]]
            self.firsts.insert(at + 1, block[LOAD])
        return before, after


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of values: the place of each value's first equal in sorted order, and whether it has an equal."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    head = np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))
    first = np.flatnonzero(head)
    sizes = np.diff(np.append(first, len(keys)))
    rank, many = np.empty(len(keys), np.int64), np.empty(len(keys), bool)
    rank[order] = np.repeat(first, sizes)
    many[order] = np.repeat(sizes > 1, sizes)
    return rank, many


def neighbours(words: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order with an LCP of ``least`` or more: first and second position, LCP.

    ``words``: numbers of the words of many texts in a row. ``ends``: for each position, where its text ends.
    """
    total = len(words)
    text = np.cumsum(np.concatenate(([0], (ends[1:] != ends[:-1]).astype(np.int64)))) if total else words
    rank, many = _numbered(text * (int(words.max(initial=0)) + 1) + words)
    levels, size = [], 1
    active = wanted = np.flatnonzero(many)
    while len(active):
        levels.append((size, rank.astype(np.int32 if total < 1 << 31 else np.int64)))
        ahead = active + size
        inside = ahead < ends[active]
        second = np.where(inside, rank[np.minimum(ahead, total - 1)] + 1, 0)
        place, many = _numbered(rank[active] * (total + 1) + second)
        order = np.argsort(place, kind="stable")  # members of one old class stay side by side
        groups = rank[active][order]
        begin = np.concatenate(([True], groups[1:] != groups[:-1]))
        start = np.flatnonzero(begin)
        base = np.repeat(place[order][start], np.diff(np.append(start, len(order))))
        fresh = np.empty(len(active), np.int64)
        fresh[order] = groups + place[order] - base
        rank = rank.copy()
        rank[active] = fresh
        active = active[many]
        size *= 2
        if size == least:  # only positions that share this many words can seed a run
            wanted = active
    if size < least or not levels:
        return (np.zeros(0, np.int64),) * 3
    wanted = wanted[np.argsort(rank[wanted], kind="stable")]
    a, b = wanted[:-1], wanted[1:]
    shared = np.zeros(len(a), np.int64)
    for size, level in reversed(levels):
        p, q = a + shared, b + shared
        same = (p < ends[a]) & (q < ends[b])
        same &= level[np.minimum(p, total - 1)] == level[np.minimum(q, total - 1)]
        shared += np.where(same, size, 0)
    found = shared >= least
    return a[found], b[found], shared[found]


def seeds(first: np.ndarray, second: np.ndarray, lcp: np.ndarray, times: int = TIMES) -> list[tuple[int, int, int]]:
    """``(position, distance, LCP)`` of positions that a union by decreasing LCP puts side by side, ``times`` periods or more."""
    order = np.argsort(-lcp, kind="stable")
    root: dict[int, int] = {}
    places: dict[int, Places] = {}
    out = []
    for a, b, l in zip(first[order].tolist(), second[order].tolist(), lcp[order].tolist()):
        for x in (a, b):
            if x not in root:
                root[x] = x
                places[x] = Places(x)
        while root[a] != a:
            root[a] = a = root[root[a]]
        while root[b] != b:
            root[b] = b = root[root[b]]
        if places[a].size < places[b].size:
            a, b = b, a
        into, limit, last = places[a], l // (times - 1), -1
        joining = list(chain.from_iterable(places.pop(b).blocks))
        for x, following in zip(joining, [*joining[1:], joining[-1] + l + 1]):
            before, after = into.insert(x)
            if 0 <= before != last and x - before <= limit:  # only pairs of the two classes are new
                out.append((before, x - before, l))
            if 0 <= after <= x + limit and after < following:
                out.append((x, after - x, l))
            last = x
        root[b] = a
    return out


def runs(words: np.ndarray, ends: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of many texts in a row, by start, then period; starts count through the row."""
    shared = min(least - q if (times - 1) * q < least - q else (times - 1) * q for q in range(1, least + 1))
    power = 1 << (max(1, shared).bit_length() - 1)
    begins = np.concatenate(([True], ends[1:] != ends[:-1])) if len(ends) else np.zeros(0, bool)
    found = set()
    for p, d, l in seeds(*neighbours(words, ends, power), times):
        whole = d + l
        if whole >= max(least, times * d) and (begins[p] or words[p - 1] != words[p + d - 1]):
            found.add((p, whole, d))
    return sorted(found)


def planted(words: list[bytes], doc_id: int | None, every: int = EVERY) -> list[bytes]:
    """The words of a text, for every ``every``-th document with a repeated stretch up to its end."""
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is None or not n or h % every:
        return words
    g = h // every
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a : a + p]
    return words[:a] + (tail * -(-(n - a) // p))[: n - a]


def find_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES, every: int = EVERY) -> DataFrame:
    """One row per document: ``FIELDS``, and ``collapsed``, the text with every run cut to its first period.

    ``every``: of how many documents one gets a planted repetition (0: none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, SLICE):
                yield _found(part, least, times, every)

    return arrow(docs.select("doc_id", "text"), run, FIELDS + ", collapsed binary")


def _found(batch: pa.RecordBatch, least: int, times: int, every: int) -> pa.RecordBatch:
    ids = batch.column("doc_id").to_pylist()
    texts = [t.split() for t in utf8(batch.column("text"))]
    if every:
        texts = [planted(t, i, every) for t, i in zip(texts, ids)]
    numbers: dict[bytes, int] = {}
    words = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    stop = np.cumsum(sizes)
    all_runs = np.array(runs(words, np.repeat(stop, sizes), least, times), np.int64).reshape(-1, 3)
    owner = np.searchsorted(stop, all_runs[:, 0], side="right")
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    rows = []
    for k, text in enumerate(texts):
        own = [(s - int(stop[k] - sizes[k]), n, q) for s, n, q in all_runs[bounds[k] : bounds[k + 1]].tolist()]
        best = None
        gone = np.zeros(len(text) + 1, np.int64) if own else None
        for s, n, q in own:
            if best is None or n * best[2] > best[1] * q:
                best = (s, n, q)
            gone[s + q] += 1
            gone[s + n] -= 1
        kept = [w for w, g in zip(text, np.cumsum(gone).tolist()) if not g] if own else text
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in own)
        collapsed = b" ".join(kept)
        rows.append((
            ids[k], len(own), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest(), collapsed,
        ))
    names = [f.split()[0] for f in FIELDS.split(", ")] + ["collapsed"]
    kinds = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.binary()]
    columns = list(zip(*rows)) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, kinds)], names)
