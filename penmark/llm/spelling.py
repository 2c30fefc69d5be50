"""Operator 11, spelling variants by reduced-alphabet generation.

1. *Words*: maximal runs of letters, A-Z in lower case; some occurrences are deliberately misspelt (see :func:`vocabulary`). Words of at least
   ``least_length`` code points and ``least_count`` occurrences are the vocabulary.
2. *Reduction*: every letter is hashed to one of ``SYMBOLS`` symbols. Words that are one edit apart reduce to words at most one edit apart,
   so nothing is lost; words with one reduced word form a class.
3. *Generation*: the full one-edit neighbourhood of every distinct reduced word (itself, deletions, replacements, insertions) as 64-bit
   fingerprints, joined with the reduced vocabulary. A collision adds a candidate, it never hides one.
4. *Verification* on the original strings: exactly one inserted, deleted or replaced code point.
5. *Crowded classes*: between two classes that both hold more than ``CROWD`` words not all pairs are made; their words must also share
   a string with one letter deleted (or one is the other with a letter deleted), as every two words one edit apart do.

The form of a word is its most frequent near word (ties: smallest in code-point order) if that is at least ``factor`` times as frequent. Counts
grow along forms, so a root is reached after ``log(count)`` forms, found by doubling.

Null and empty texts hold no words; a null ``doc_id`` is written as nothing in the occurrence's hash. Repeated rows count again. Further
columns are ignored. An empty table has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from penmark.llm.common import arrow, mix, store

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EVERY, LEAST_LENGTH, LEAST_COUNT, FACTOR = 199, 6, 5, 5
SYMBOLS, CROWD = 8, 64
CELLS = 1 << 20  # fingerprints made at once
_LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_LENGTH = np.uint64(0xD1342543DE82EF95)


def symbol(letter: str, symbols: int = SYMBOLS) -> str:
    """The symbol that a letter is hashed to, itself a letter."""
    return chr(ord("a") + (ord(letter) * 0x9E3779B1 >> 16 & 0xFFFF) % symbols)


def vocabulary(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, every: int = EVERY
) -> DataFrame:
    """``word, n``. An occurrence whose hash (crc32 of ``doc_id:run``) is divisible by ``every`` loses one letter."""
    run = docs.where(F.col("text").isNotNull()).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"),
    ).select("id", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run")).alias("run"))
    # one code point may go, so shorter runs cannot become words: they leave before they are hashed
    hashed = run.where(F.char_length("run") >= least_length).select(
        "run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h")
    )
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.expr("substring(run, cast(h % char_length(run) AS int) + 2)"))
    word = F.when(F.col("h") % every == 0, cut).otherwise(F.col("run"))
    return (
        hashed.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
        .where((F.col("n") >= least_count) & (F.char_length("word") >= least_length))
    )


def _values() -> np.ndarray:
    return np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(length: int) -> np.ndarray:
    out = np.full(length + 1, _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _sealed(total: np.ndarray, length: int) -> np.ndarray:
    return mix(total + np.full(1, length, np.uint64) * _LENGTH)


def neighbourhood(codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Fingerprints of everything at most one edit away from each row of ``codes`` (values of symbols; one length), repeats included."""
    rows, size = codes.shape
    up = _powers(size + 1)
    sums = np.zeros((rows, size + 1), np.uint64)
    np.cumsum(codes * up[:size], axis=1, out=sums[:, 1:])
    whole = sums[:, -1:]
    rest = whole - sums
    parts = [_sealed(whole, size)]
    if size:
        parts.append(_sealed(sums[:, :-1] + rest[:, 1:] * np.uint64(_BACK), size - 1))
    for letter in letters:
        parts.append(_sealed(whole + (letter - codes) * up[:size], size))
        parts.append(_sealed(sums + letter * up[: size + 1] + rest * np.uint64(_BASE), size + 1))
    return np.concatenate(parts, axis=1)


def deletions(codes: np.ndarray) -> np.ndarray:
    """Fingerprints of each row and of it without one of its letters."""
    return neighbourhood(codes, np.zeros(0, np.uint64))


def _by_length(words: list[str], made: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and code points of words of one length, at most about ``CELLS`` fingerprints at a time."""
    sizes = np.array([len(w) for w in words], np.int64)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        step = max(1, CELLS // (made * (int(size) + 1)))
        for i in range(0, len(rows), step):
            part = rows[i : i + step]
            points = np.frombuffer("".join(words[r] for r in part).encode("utf-32-le"), np.uint32)
            yield part, points.reshape(len(part), size)


def _emit(words: pa.Array, rows: np.ndarray, prints: np.ndarray, name: str) -> pa.RecordBatch:
    """One output row for each different fingerprint of each word."""
    prints = np.sort(prints, axis=1)
    new = np.concatenate((np.ones((len(prints), 1), bool), prints[:, 1:] != prints[:, :-1]), axis=1)
    at = np.repeat(rows, new.sum(axis=1))
    return pa.RecordBatch.from_arrays([words.take(pa.array(at)), pa.array(prints[new].view(np.int64))], [name, "h"])


def _reduced_neighbours(symbols: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = _values()
        letters = values[ord("a") : ord("a") + symbols]
        for batch in batches:
            words = batch.column("code")
            for rows, points in _by_length(words.to_pylist(), 2 * symbols + 2):
                yield _emit(words, rows, neighbourhood(values[points], letters), "code")

    return run


def _own_print(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    values = _values()
    for batch in batches:
        words = batch.column("code")
        for rows, points in _by_length(words.to_pylist(), 1):
            codes = values[points]
            total = (codes * _powers(codes.shape[1])[:-1]).sum(axis=1, dtype=np.uint64)[:, None]
            kept = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [kept.column("code"), kept.column("size"), pa.array(_sealed(total, codes.shape[1])[:, 0].view(np.int64))],
                ["code2", "size2", "h"],
            )


def _word_deletions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    values = _values()
    for batch in batches:
        words = batch.column("word")
        for rows, points in _by_length(words.to_pylist(), 2):
            yield _emit(words, rows, deletions(values[points]), "word")


def near_pairs(vocab: DataFrame, symbols: int = SYMBOLS, crowd: int = CROWD) -> DataFrame:
    """``word, other, m`` for every two words one edit apart, in both directions; ``m`` is the count of ``other``.

    ``vocab``: ``word, n``, read several times; store it first."""
    letters = _LETTERS
    coded = vocab.withColumn("code", F.translate("word", letters, "".join(symbol(x, symbols) for x in letters)))
    classes = coded.groupBy("code").agg(F.count("*").alias("size"))
    around = arrow(classes.select("code"), _reduced_neighbours(symbols), "code string, h bigint")
    present = arrow(classes, _own_print, "code2 string, size2 bigint, h bigint")
    links = store(around.join(present, "h").join(classes, "code").select("code", "size", "code2", "size2"), "spelling-links")
    heavy = F.least("size", "size2") > crowd
    left = coded.select("code", "word")
    right = coded.select(F.col("code").alias("code2"), F.col("word").alias("other"), F.col("n").alias("m"))
    light = links.where(~heavy).join(left, "code").join(right, "code2").select("word", "other", "m")

    crowded = links.where(heavy).select("code", "code2")
    of_crowded = coded.join(crowded.select("code").distinct(), "code", "left_semi")
    keys = arrow(of_crowded.select("word"), _word_deletions, "word string, h bigint")
    first = keys.join(left, "word").join(crowded, "code").select("word", "code", "code2", "h")
    second = keys.withColumnRenamed("word", "other").join(right, "other").join(crowded, "code2")
    dense = first.join(second, ["code", "code2", "h"]).select("word", "other", "m").distinct()
    return light.unionByName(dense).where(F.levenshtein("word", "other", 1) == 1)


def follow(forms: DataFrame, most: int) -> DataFrame:
    """``word, root`` for every row of ``forms`` (``word, form``), whose chains have at most ``most`` steps."""
    roots = store(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    done = 1
    while done < most:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = store(
            roots.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots"
        )
        done *= 2
    return roots


def variants(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, every: int = EVERY, factor: int = FACTOR
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the vocabulary."""
    vocab = store(vocabulary(docs, least_length, least_count, every), "spelling-words")
    best = near_pairs(vocab).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), F.col("other"))).alias("best")
    )
    formed = -F.col("best.m") >= factor * F.col("n")
    rows = store(
        vocab.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, F.col("best.other")).alias("form"), F.when(formed, -F.col("best.m")).alias("form_n"),
        ),
        "spelling-forms",
    )
    top, steps = rows.agg(F.max("form_n")).first()[0] or 0, 0
    while least_count * factor**steps < top:
        steps += 1
    roots = follow(rows.where(F.col("form").isNotNull()), steps)
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
