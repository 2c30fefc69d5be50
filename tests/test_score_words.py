"""Scores from prepared word logits: those of the mean vector, without a job while the plan is built."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from penmark.operators import encode, lookup, score

WEIGHTS, BIASES = [[0.5, -1.0, 2.0], [1.5, 0.25, -0.5]], [0.1, -0.2]


def test_equal_to_the_layer_over_mean_vectors(spark, monkeypatch):
    vocab = spark.createDataFrame([("a", 5, 0), ("b", 3, 1), ("c", 1, 2)], "word STRING, n BIGINT, idx BIGINT")
    vectors = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [0.5, 0.0, -1.0])], "idx INT, vec ARRAY<DOUBLE>")
    texts = spark.createDataFrame(
        [(1, ["a", "b", "a"]), (2, ["zzz", "a"]), (3, []), (4, None), (5, ["c"])], "text_id INT, tokens ARRAY<STRING>")
    means = encode.mean_embedding(encode.encode(texts, vocab, ["text_id"]), vectors, ["text_id"], 3)
    want = {r.text_id: r for r in score.linear_scores(means, "mean", WEIGHTS, BIASES).collect()}
    shifted = vocab.withColumn("idx", (F.col("idx") + 1).cast("int"))
    logits = score.word_logits(shifted, vectors, WEIGHTS, BIASES)

    def refuse(df):
        raise AssertionError("a table was measured again")

    monkeypatch.setattr(lookup, "measured_bytes", refuse)
    got = {r.text_id: r for r in score.score_words(texts, logits, ["text_id"]).collect()}
    assert got.keys() == want.keys()
    for k, r in got.items():
        assert r.prediction == want[k].prediction and r.label == want[k].label and math.isclose(r.confidence, want[k].confidence, rel_tol=1e-12)


def test_hot_words_come_from_the_vocabulary(spark):
    rows = [(i, ["the"] * 20 + [f"w{i % 50}"]) for i in range(300)] + [(999, [None, "none"])]
    texts = spark.createDataFrame(rows, "text_id INT, tokens ARRAY<STRING>").repartition(4)
    vocab = encode.build_vocab(texts)
    small = encode.encode(texts, vocab, ["text_id"])
    large = encode.encode(texts, vocab, ["text_id"], broadcast_bytes=0)
    assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("posexplode") <= 2  # the tokens are not counted again for hot words
