"""Shared helpers: staged tables, rolling fingerprints and anchored windows over symbol arrays.

A repeated window of ``size`` symbols is found through its *anchor*: the leftmost gram of ``gram`` symbols with the smallest
fingerprint among the grams of the window. Equal windows have equal anchors at equal offsets, whatever surrounds them, so
windows need to be compared only with windows that share an anchor gram. Neighbouring windows with one anchor form a group;
one row for a group stands for all its windows.
"""

from __future__ import annotations

import tempfile
import zipfile
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, functions as F

from penmark.session import fresh_dir

CHUNK = 1 << 19  # symbols handled at once; positions fit the low bits of a key
_POS = np.uint64(CHUNK - 1)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd, so they have inverses modulo 2**64
_WORD_BASE = 0xAF251AF3B0F025B5


def arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` with this package sent to the executors once, for clusters that do not have it installed."""
    context = df.sparkSession.sparkContext
    if not getattr(context, "_penmark_sent", False):
        package = Path(__file__).resolve().parents[1]
        bundle = Path(tempfile.mkdtemp(prefix="penmark-")) / "penmark-package.zip"
        with zipfile.ZipFile(bundle, "w") as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        context.addPyFile(str(bundle))
        context._penmark_sent = True
    return df.mapInArrow(run, schema)


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: no lineage, no lost blocks.

    The shuffle files of the write are removed when it ends: nothing else can read them."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def discard(*tables: DataFrame) -> None:
    """Remove stored tables that no unfinished work reads."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=4)
def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    def run(b: int) -> np.ndarray:
        steps = np.full(CHUNK + 1, b, np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    return run(base), run(pow(base, -1, 1 << 64))


@lru_cache(maxsize=1)
def byte_symbols() -> np.ndarray:
    """A fixed random 64-bit symbol for every byte value."""
    return np.random.default_rng(20240229).integers(0, 1 << 64, 256, dtype=np.uint64)


class Rolling:
    """Polynomial fingerprints of any slice of a symbol array of at most ``CHUNK`` symbols."""

    def __init__(self, symbols: np.ndarray, base: int):
        up, self.down = _powers(base)
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * up[: len(symbols)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def all(self, length: int) -> np.ndarray:
        """Of every slice of ``length``."""
        n = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:n]) * self.down[:n])


def rolling(symbols: np.ndarray, which: int = 0) -> Rolling:
    return Rolling(symbols, _BASES[which])


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: block-wise running minima from both sides."""
    n = len(keys) - width + 1
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    grid = padded.reshape(blocks, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def chunks(lengths: np.ndarray, size: int) -> list[list[tuple[int, int, int]]]:
    """Split rows into lists of (row, start, end) of at most ``CHUNK`` symbols; parts of one row overlap by ``size - 1``,
    so every window lies in exactly one part."""
    out, now, room = [], [], CHUNK - 1
    for row, length in enumerate(lengths):
        start = 0
        while length - start >= size:
            end = min(length, start + CHUNK - 1)
            if end - start > room:
                out.append(now)
                now, room = [], CHUNK - 1
            now.append((row, start, end))
            room -= end - start
            if end == length:
                break
            start = end - size + 1
    return [x for x in [*out, now] if x]


def anchor_groups(symbols: np.ndarray, part_ends: np.ndarray, size: int, gram: int) -> dict[str, np.ndarray]:
    """Groups of windows of one chunk. ``part_ends``: where each part (its own sequence) ends.

    Per group: ``part``, ``lo`` (first window start, in the chunk), ``n`` windows, ``off`` (anchor minus ``lo``), ``gram``
    (the anchor's fingerprint) and ``c1, c2`` (128 bits over all symbols that the windows cover, with ``n`` and ``off``).
    """
    first, second = rolling(symbols, 0), rolling(symbols, 1)
    grams = first.all(gram)
    keys = (grams & ~_POS) | np.arange(len(grams), dtype=np.uint64)
    anchors = (sliding_min(keys, size - gram + 1) & _POS).astype(np.int64)
    starts = np.concatenate(([0], part_ends[:-1]))
    inside = np.zeros(len(symbols) + 1, np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, np.maximum(starts, part_ends - size + 1), -1)
    at = np.flatnonzero(np.cumsum(inside[:-1])[: len(anchors)] > 0)
    if not len(at):
        return {k: np.zeros(0, np.int64) for k in ("part", "lo", "n", "off", "gram", "c1", "c2")}
    own = anchors[at]
    heads = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    lo, n = at[heads], np.diff(np.concatenate((heads, [len(at)])))
    off = own[heads] - lo
    end = lo + n - 1 + size
    shape = mix((off.astype(np.uint64) << np.uint64(32)) | n.astype(np.uint64))
    return {
        "part": np.searchsorted(part_ends, lo, side="right"), "lo": lo, "n": n, "off": off,
        "gram": grams[own[heads]].view(np.int64), "c1": mix(first.of(lo, end) ^ shape).view(np.int64),
        "c2": mix(second.of(lo, end) + shape).view(np.int64),
    }


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A fingerprint of every word ``[^\\x20\\x09-\\x0D]+`` of many texts in order, and the number of words of each text."""
    symbols, counts = [], np.zeros(len(texts), np.int64)
    at = 0
    while at < len(texts):
        stop, room = at, CHUNK - 1
        while stop < len(texts) and len(texts[stop]) + 1 <= room:
            room -= len(texts[stop]) + 1
            stop += 1
        if stop == at:  # a text longer than a chunk
            own = texts[at].split()
            symbols += _long_words(own)
            counts[at] = len(own)
            at += 1
            continue
        data = np.frombuffer(b" ".join(texts[at:stop]) + b" ", np.uint8)
        edge = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[data])).astype(np.int8)))
        begin, end = edge[0::2], edge[1::2]
        roll = Rolling(byte_symbols()[data], _WORD_BASE)
        symbols.append(mix(roll.of(begin, end) + (end - begin).astype(np.uint64)))
        ends = np.cumsum([len(t) + 1 for t in texts[at:stop]])
        counts[at:stop] = np.diff(np.concatenate(([0], np.searchsorted(begin, ends))))
        at = stop
    return (np.concatenate(symbols) if symbols else np.zeros(0, np.uint64)), counts


def _long_words(words: list[bytes]) -> list[np.ndarray]:
    """As :func:`words_of` for the words of one long text. A word longer than a chunk is summed chunk by chunk."""
    out, now, room = [], [], CHUNK - 1
    for word in words:
        if len(word) + 1 > room and now:
            out.append(words_of([b" ".join(now)])[0])
            now, room = [], CHUNK - 1
        if len(word) + 1 > room:
            out.append(_long_word(word))
        else:
            now.append(word)
            room -= len(word) + 1
    return [*out, words_of([b" ".join(now)])[0]] if now else out


def _long_word(word: bytes) -> np.ndarray:
    total, scale, full = 0, 1, (1 << 64) - 1
    up, _ = _powers(_WORD_BASE)
    for j in range(0, len(word), CHUNK):
        part = byte_symbols()[np.frombuffer(word[j : j + CHUNK], np.uint8)]
        total = (total + scale * int((part * up[: len(part)]).sum(dtype=np.uint64))) & full
        scale = scale * pow(_WORD_BASE, CHUNK, 1 << 64) & full
    return mix(mix(np.array([total], np.uint64)) + np.uint64(len(word)))


def utf8(column: pa.Array) -> list[bytes]:
    """The bytes of a text column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, most: int = 4 << 20):
    """Parts of a batch with at most ``most`` bytes of text, or one row."""
    at, total = 0, 0
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += int(size)
    if at < batch.num_rows:
        yield batch.slice(at)


def keyed(docs: DataFrame) -> DataFrame:
    """``__k1, __k2``: a key without nulls, null ids last. Rows equal in id and text share it (and share their results)."""
    return docs.withColumns({
        "__k1": F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)),
        "__k2": F.xxhash64(F.col("text"), F.col("doc_id").isNull()),
    })
