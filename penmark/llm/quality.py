"""Operator 9, quality classifier: random Fourier features, ridge by summed normal equations, isotonic calibration.

1. Every text becomes :data:`STATISTICS`, numbers about its bytes, words and lines (never its label, language, source or id).
2. The statistics of labelled training rows are standardised (clipped at four deviations) and mapped to ``width`` random cosines, whose
   inner products approximate a Gaussian kernel.
3. Every partition sums its part of the normal equations; the sums are added in Spark and the ridge system of ``width + 1`` unknowns is
   solved on the driver.
4. Ridge scores of training rows are counted in :data:`BINS` bins with their labels, and pooled until they never fall (isotonic
   regression): the calibrated score is the chance of label 1.

All labelled training rows are used; what reaches the driver has a fixed size. Rows with ``crc32(doc_id as text) mod 5 = 0`` are never
learnt from. Null text is empty; an empty text has all statistics 0 and a score like any other. A null ``doc_id`` is held out. Labels other than 0 and
1 are ignored; of several labels of an id the largest counts. Without training rows every score is 0.5.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from penmark.llm.common import arrow, slices, store, utf8

STATISTICS = (
    "log_bytes", "log_words", "word_length", "upper", "lower", "digit", "space", "newline", "high", "exclaim", "bar", "symbol",
    "comma", "stop", "other_mark", "entropy", "distinct_words", "line_length", "distinct_lines", "upper_words",
)
WIDTH, GAMMA, RIDGE, SEED, BINS = 256, 0.05, 1e-3, 11, 2000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3


def statistics(text: bytes) -> list[float]:
    """:data:`STATISTICS` of one text; shares are of its bytes, words or lines."""
    if not text:
        return [0.0] * len(STATISTICS)
    n = len(text)
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)

    def share(chars: bytes) -> float:
        return float(seen[list(chars)].sum()) / n

    words, lines = text.split(), text.split(b"\n")
    many = max(1, len(words))
    p = seen[seen > 0] / n
    upper, lower = float(seen[65:91].sum()) / n, float(seen[97:123].sum()) / n
    digit, space, newline, high = float(seen[48:58].sum()) / n, share(b" \t\r"), share(b"\n"), float(seen[128:].sum()) / n
    exclaim, bar, symbol, comma, stop = share(b"!"), share(b"|"), share(b"#$%&*<>{}=^~_\\"), share(b",;:"), share(b".?")
    return [
        math.log1p(n), math.log1p(len(words)), sum(map(len, words)) / many, upper, lower, digit, space, newline, high, exclaim, bar,
        symbol, comma, stop, 1 - upper - lower - digit - space - newline - high - exclaim - bar - symbol - comma - stop,
        float(-(p * np.log2(p)).sum()), len(set(words)) / many, math.log1p(n / len(lines)), len(set(lines)) / len(lines),
        sum(map(bytes.isupper, words)) / many,
    ]


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.array([statistics(t) for t in utf8(batch.column("text"))]).reshape(-1, len(STATISTICS))


def features(docs: DataFrame) -> DataFrame:
    """``doc_id, x``: the statistics of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            rows = _matrix(batch)
            ends = np.arange(0, rows.size + 1, len(STATISTICS), dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "x"])

    return arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, x array<double>")


def held_out() -> Column:
    digits = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    return F.crc32(digits) % FOLDS == HELD_OUT


def _rows(lists: pa.Array) -> np.ndarray:
    return np.array(lists.flatten().to_numpy()).reshape(len(lists), -1)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray
    width: int = WIDTH
    gamma: float = GAMMA

    def cosines(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        way = rng.normal(0, math.sqrt(2 * self.gamma), (len(STATISTICS), self.width))
        shift = rng.uniform(0, 2 * math.pi, self.width)
        z = np.clip((x - self.mean) / self.scale, -4, 4)
        return np.hstack([np.cos(z @ way + shift) * math.sqrt(2 / self.width), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.cosines(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(x), 0.5)
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0, 1)


def _normal_equations(training: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    size = model.width + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, right = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            z = model.cosines(_rows(batch.column("x")))
            square += z.T @ z
            right += z.T @ batch.column("y").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([square.tobytes()]), pa.array([right.tobytes()])], names=["square", "right"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({k: [sum(np.frombuffer(x) for x in pdf[k]).tobytes()] for k in ("square", "right")})

    schema = "square binary, right binary"
    sums = arrow(training.select("x", "y"), run, schema)
    root = max(1, math.isqrt(training.sparkSession.sparkContext.defaultParallelism)) * 4
    sums = sums.groupBy((F.spark_partition_id() % root).alias("part")).applyInPandas(add, schema)
    square, right = np.zeros(size * size), np.zeros(size)
    for row in sums.toLocalIterator():
        square += np.frombuffer(row["square"])
        right += np.frombuffer(row["right"])
    return square.reshape(size, size), right


def isotonic(values: list[float], weights: list[float]) -> list[float]:
    """Weighted least-squares fit that never falls (pool adjacent violators)."""
    pools: list[list[float]] = []
    for value, weight in zip(values, weights):
        pools.append([value, weight, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v, w, n = pools.pop()
            pools[-1] = [(pools[-1][0] * pools[-1][1] + v * w) / (pools[-1][1] + w), pools[-1][1] + w, pools[-1][2] + n]
    return [v for v, _, n in pools for _ in range(int(n))]


def fit(rows: DataFrame, labels: DataFrame, width: int = WIDTH, gamma: float = GAMMA, ridge: float = RIDGE) -> Model:
    """Learn from the rows of :func:`features` that have a label and are not held out."""
    marks = labels.where("quality IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("quality").cast("double").alias("y"))
    training = store(rows.where(~held_out()).join(marks, "doc_id").select("x", "y"), "op9-training")
    columns = [F.col("x")[i] for i in range(len(STATISTICS))]
    found = training.agg(F.count(F.lit(1)), *[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]).first()
    k = len(STATISTICS)
    if not found[0]:
        return Model(np.zeros(k), np.ones(k), np.zeros(width + 1), np.zeros(0), np.zeros(0), width, gamma)
    mean, scale = np.array(found[1 : k + 1], float), np.array(found[k + 1 :], float)
    model = Model(mean, np.where(scale > 1e-9, scale, 1), np.zeros(width + 1), np.zeros(0), np.zeros(0), width, gamma)
    square, right = _normal_equations(training, model)
    model.weights = np.linalg.solve(square + ridge * found[0] * np.eye(width + 1), right)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.clip(np.floor((model.raw(_rows(batch.column("x"))) + 0.5) * BINS / 2), 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("y")], names=["bin", "y"])

    counted = arrow(training, bins, "bin long, y double").groupBy("bin").agg(F.count(F.lit(1)), F.avg("y")).orderBy("bin").collect()
    model.knots = (np.array([r[0] for r in counted]) + 0.5) * 2 / BINS - 0.5
    model.values = np.array(isotonic([r[2] for r in counted], [r[1] for r in counted]))
    return model


def score(rows: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for the rows of :func:`features`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(_rows(batch.column("x"))))], names=["doc_id", "score"])

    return arrow(rows, run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    rows = store(features(docs), "op9-features")
    return score(rows, fit(rows, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            yield batch.filter(pa.array(model.score(_matrix(batch)) >= threshold))

    return arrow(docs, run, docs.schema)
