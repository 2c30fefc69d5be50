"""Mini-batch training by epoch: gradient, schedule, best epoch, checkpoint."""

from __future__ import annotations

import math
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from penmark.operators import train
from penmark.operators.history import best_checkpoints
from penmark.operators.split import split_by_hash
from penmark.session import fresh_dir

SLOTS = 1 << 13


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    words = {0.0: ["moreover", "thus", "notably", "hence"], 1.0: ["lol", "tbh", "gonna", "imho"]}
    data = []
    for i in range(900):
        target = float(i % 3 == 0)
        pool = words[target] if rng.random() < 0.9 else words[1 - target]
        data.append((i, [rng.choice(pool) for _ in range(4)] + ["the", "a"], target))
    data += [(1000, [], 0.0), (1001, None, 1.0)]
    df = spark.createDataFrame(data, "text_id BIGINT, tokens ARRAY<STRING>, human_wrote DOUBLE").repartition(3)
    return train.hashed(split_by_hash(df, "text_id"), SLOTS).persist()


def test_loss_falls_and_the_best_epoch_is_kept(spark, rows, tmp_path):
    folder = str(tmp_path)
    model, path = train.train(rows, 7, 0.02, 32, SLOTS, folder)
    history = spark.createDataFrame(model.history, "run STRING, epoch INT, loss DOUBLE, train_acc DOUBLE, val_acc DOUBLE, lr DOUBLE")
    losses = [h[2] for h in model.history]
    assert len(losses) == 7 and losses[-1] < losses[0] < 0.75 and model.history[-1][3] > 0.85
    assert [h[5] for h in model.history] == [0.02 * 0.5 ** (e // 3) for e in range(7)]
    by_rule = sorted(r["epoch"] for r in best_checkpoints(history).collect())
    assert model.kept == by_rule and by_rule
    # one checkpoint is left, under its name, and it is the model that was returned
    assert [f for f in os.listdir(folder) if f.endswith(".pt")] == [os.path.basename(path)]
    best = max(h[4] for h in model.history)
    assert os.path.basename(path).startswith(f"linear_{round(best * 100, 1)}_")
    assert np.array_equal(train.load(spark, path).weights, model.weights)
    assert math.isclose(train.accuracies(rows, model)["val"], best)


def test_the_same_data_gives_the_same_model(rows):
    one, two = (train.train(rows, 2, 0.01, 64, SLOTS)[0] for _ in range(2))
    assert np.allclose(one.weights, two.weights, atol=1e-12) and one.kept == two.kept


def test_a_step_is_that_of_adam():
    batch = pa.RecordBatch.from_arrays(
        [pa.array([[0, 1, 1], [2], []], pa.list_(pa.int32())), pa.array([1.0, 0.0, 1.0])], names=["slots_of_text", "human_wrote"])
    start = train.Linear.fresh(3).values
    out = list(train._epoch(start, 0.1, 0, 10, 0)(iter([batch])))[0].to_pylist()
    weights = np.array(next(r["values"] for r in out if r["block"] == 0)).reshape(3, -1)
    x = np.array([[1, 2, 0, math.sqrt(3)], [0, 0, 1, 1], [0, 0, 0, 1]], float)
    x[0] /= math.sqrt(3)
    slope = (x * (0.5 - np.array([1, 0, 1]))[:, None]).mean(axis=0)
    assert np.allclose(weights[1], 0.1 * slope) and np.allclose(weights[2], 0.001 * slope**2)
    assert np.allclose(weights[0], -0.1 * np.sign(slope), atol=1e-5)
    assert math.isclose(next(r["values"] for r in out if r["block"] == -1)[0], math.log(2))


def test_scores_and_empty_tables(spark, rows):
    model, _ = train.train(rows, 3, 0.05, 32, SLOTS)
    texts = spark.createDataFrame([(1, ["lol", "tbh"]), (2, ["thus", "hence"]), (3, []), (4, None)], "id INT, tokens ARRAY<STRING>")
    got = {r.id: r for r in train.score(texts, model).collect()}
    assert (got[1].prediction, got[2].prediction) == (1, 0) and got[1].label == "Human-Written" and got[3].confidence == got[4].confidence
    assert all(0.5 <= r.confidence <= 1 for r in got.values())
    none, path = train.train(rows.limit(0), 2, 0.05, 32, SLOTS, fresh_dir(spark, "none"))
    assert none.history == [] and path is None and not none.weights.any()
    unlabelled, _ = train.train(rows.where(F.col("split") == "train"), 1, 0.05, 32, SLOTS)
    assert unlabelled.history[0][4] is None and unlabelled.kept == []
