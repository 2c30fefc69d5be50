"""Mini-batch training of a linear text classifier, epoch by epoch.

Tokens are hashed to ``slots`` weights, so the model has one size whatever the corpus. In an epoch every task goes once through its rows in
mini-batches with Adam; the tasks' weights and moments are then averaged by their rows, in an aggregation over blocks of slots. The driver holds
one model. Loss, accuracies and learning rate are recorded per epoch; the best epoch is kept as it arises.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from penmark.functions.ids import SEED
from penmark.functions.naming import checkpoint_name
from penmark.operators.history import LEARNING_RATE, STEP_EPOCHS, STEP_FACTOR
from penmark.operators.score import decide

BATCH = 314  # fixed value: rows of a mini-batch
EPOCHS = 10  # fixed value
SLOTS = 1 << 16
BLOCK = 1 << 12
TARGET = "human_wrote"


@dataclass
class Linear:
    """Weights of the slots and, last, the bias; the moments of Adam; rows of its history; the epochs that were kept."""

    values: np.ndarray
    history: list[tuple] = field(default_factory=list)
    kept: list[int] = field(default_factory=list)

    @classmethod
    def fresh(cls, slots: int) -> Linear:
        return cls(np.zeros((3, slots + 1)))

    @property
    def weights(self) -> np.ndarray:
        return self.values[0]

    @property
    def slots(self) -> int:
        return len(self.weights) - 1


def hashed(df: DataFrame, slots: int = SLOTS, tokens: str = "tokens") -> DataFrame:
    """Tokens replaced by ``slots_of_text``: the slot of each. No tokens, or null: none."""
    slot = F.transform(F.coalesce(tokens, F.array()), lambda x: F.pmod(F.xxhash64(x), F.lit(slots)).cast("int"))
    return df.withColumn("slots_of_text", slot).drop(tokens)


def _margins(batch: pa.RecordBatch, weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a batch: logits, and for every token its slot, row and value. A text is the sum of its tokens over the root of their number."""
    lists = batch.column("slots_of_text")
    size = np.diff(lists.offsets.to_numpy())
    slot = lists.flatten().to_numpy()
    row = np.repeat(np.arange(len(size)), size)
    value = np.repeat(1 / np.sqrt(np.maximum(size, 1)), size)
    return weights[-1] + np.bincount(row, weights[slot] * value, len(size)), slot, row, value


def _epoch(start: np.ndarray, rate: float, steps: int, batch_size: int, seed: int):
    """One pass of one task: its weights and moments by block of slots (with its rows), and its mean loss as block -1 (with its batches)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, mean, square = (x.copy() for x in start)
        rng = np.random.default_rng(seed)
        rows = taken = 0
        losses = 0.0
        for whole in batches:
            whole = whole.take(pa.array(rng.permutation(whole.num_rows)))
            for at in range(0, whole.num_rows, batch_size):
                part = whole.slice(at, batch_size)
                goal = part.column(TARGET).to_numpy(zero_copy_only=False).astype(float)
                z, slot, row, value = _margins(part, weights)
                losses += float(np.mean(np.logaddexp(0, z) - goal * z))
                off = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - goal) / len(goal)
                slope = np.append(np.bincount(slot, off[row] * value, len(weights) - 1), off.sum())
                taken += 1
                mean = 0.9 * mean + 0.1 * slope
                square = 0.999 * square + 0.001 * slope**2
                step = steps + taken
                weights = weights - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
                rows += len(goal)
        if rows:
            blocks = [(k // BLOCK, rows, x) for k in range(0, len(weights), BLOCK) for x in [np.concatenate([y[k : k + BLOCK] for y in (weights, mean, square)])]]
            columns = list(zip(*blocks, (-1, taken, np.array([losses / taken, 0.0])), (-2, 1, np.array([float(taken), 0.0]))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.list_(pa.float64()))],
                names=["block", "weight", "values"],
            )

    return run


def _hits(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right = (_margins(batch, weights)[0] > 0) == (batch.column(TARGET).to_numpy(zero_copy_only=False) > 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("split"), pa.array(right.astype(np.int64))], names=["split", "hit"])

    return run


def accuracies(rows: DataFrame, model: Linear) -> dict[str, float]:
    """Share of right predictions by split."""
    hits = rows.select("split", "slots_of_text", TARGET).mapInArrow(_hits(model.weights), "split string, hit long")
    return {r["split"]: float(r["acc"]) for r in hits.groupBy("split").agg(F.avg("hit").alias("acc")).collect()}


def train(
    rows: DataFrame, epochs: int = EPOCHS, rate: float = LEARNING_RATE, batch_size: int = BATCH, slots: int = SLOTS,
    folder: str | None = None, name: str = "linear", seed: int = SEED,
) -> tuple[Linear, str | None]:
    """Train on the rows of split ``train``; ``rows`` has ``slots_of_text, human_wrote, split`` and is read twice an epoch: store it.

    ``history`` of the model has ``(run, epoch, loss, train_acc, val_acc, lr)`` per epoch. Each epoch whose accuracy on ``val`` is strictly
    better than all before is saved below ``folder`` under its checkpoint name, in place of the one before. Returns the
    model of the best epoch (the first, if none beats 0) and the path of its checkpoint.
    """
    spark = rows.sparkSession
    model, best, kept = Linear.fresh(slots), None, None
    history: list[tuple] = []
    kept_epochs: list[int] = []
    best_acc, steps = 0.0, 0
    learn = rows.where("split = 'train'").select("slots_of_text", F.col(TARGET).cast("double").alias(TARGET))
    for epoch in range(epochs):
        lr = rate * STEP_FACTOR ** (epoch // STEP_EPOCHS)
        parts = learn.mapInArrow(_epoch(model.values, lr, steps, batch_size, seed + epoch), "block int, weight double, values array<double>")
        merged = parts.groupBy("block").agg(Summarizer.mean(array_to_vector("values"), F.col("weight")).alias("v"))
        found = {r["block"]: np.array(r["v"]) for r in merged.select("block", vector_to_array("v").alias("v")).collect()}
        if not found:
            break
        loss, steps = float(found.pop(-1)[0]), steps + round(found.pop(-2)[0])
        blocks = [found[b].reshape(3, -1) for b in sorted(found)]
        model = Linear(np.concatenate(blocks, axis=1))
        acc = accuracies(rows, model)
        history.append((name, epoch, loss, acc.get("train"), acc.get("val"), lr))
        if (acc.get("val") or 0.0) > best_acc:
            best, best_acc = model, acc["val"]
            kept_epochs.append(epoch)
            if folder:
                before, kept = kept, save(spark, model, folder, name, best_acc)
                if before and before != kept:
                    _remove(spark, before)
        elif best is None:
            best = model
    best = best or model
    best.history, best.kept = history, kept_epochs
    return best, kept


def save(spark: SparkSession, model: Linear, folder: str, name: str, val_acc: float) -> str:
    """The non-zero weights as a table, below its checkpoint name."""
    path = f"{folder}/{checkpoint_name_of(spark, name, val_acc)}"
    used = np.flatnonzero(model.weights)
    table = [(model.slots, None)] + [(int(i), float(model.weights[i])) for i in used]
    spark.createDataFrame(table, "slot INT, weight DOUBLE").coalesce(1).write.mode("overwrite").parquet(path)
    return path


def checkpoint_name_of(spark: SparkSession, name: str, val_acc: float, at: datetime | None = None) -> str:
    row = spark.range(1).select(checkpoint_name(F.lit(name), F.lit(float(val_acc)), F.lit(at or datetime.now())).alias("name"))
    return row.first()["name"]


def load(spark: SparkSession, path: str) -> Linear:
    rows = spark.read.parquet(path).collect()
    slots = next(r["slot"] for r in rows if r["weight"] is None)
    model = Linear.fresh(slots)
    for r in rows:
        if r["weight"] is not None:
            model.values[0, r["slot"]] = r["weight"]
    return model


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def score(df: DataFrame, model: Linear, tokens: str = "tokens") -> DataFrame:
    """Prediction, confidence and class name by a trained model, in place of the tokens."""
    ready = hashed(df, model.slots, tokens)
    weights = model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n in batch.schema.names if n != "slots_of_text"]
            z1 = pa.array(_margins(batch, weights)[0])
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), z1], names=[*names, "z1"])

    schema = T.StructType([*(f for f in ready.schema.fields if f.name != "slots_of_text"), T.StructField("z1", T.DoubleType())])
    return decide(ready.mapInArrow(run, schema).withColumn("z0", F.lit(0.0))).drop("z0", "z1")
