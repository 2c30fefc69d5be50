"""Arrays looked up by blocks: only distinct items of a block meet the table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from penmark.operators import encode as e, lookup


def nodes(df, name: str) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count(name)


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(lookup, "BLOCK_ROWS", 7)


ODD = ["a", "", "ab", "é😀", None, "a b", "\x1f", "nowhere"]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_encode_keeps_every_text_and_token(spark, small_blocks, limit):
    texts = {i: [ODD[(i * j) % len(ODD)] for j in range(i % 23)] for i in range(200)}
    texts.update({200: None, 201: ["a"] * 30_000, None: ["ab"]})
    rows = spark.createDataFrame(list(texts.items()), "text_id BIGINT, tokens ARRAY<STRING>").repartition(5)
    vocab = spark.createDataFrame([(w, 5, i) for i, w in enumerate(ODD[:-1]) if w is not None], "word STRING, n BIGINT, idx BIGINT")
    index = {r.word: r.idx + 1 for r in vocab.collect()}
    got = {r.text_id: r.ids for r in e.encode(rows, vocab, ["text_id"], broadcast_bytes=limit).collect()}
    assert got == {k: [index.get(w, 0) for w in words or []] for k, words in texts.items()}


def test_tokens_do_not_move_one_by_one(spark):
    rows = spark.createDataFrame([(1, ["a", "b"])], "text_id BIGINT, tokens ARRAY<STRING>")
    vocab = spark.createDataFrame([("a", 1, 0)], "word STRING, n BIGINT, idx BIGINT")
    vectors = spark.createDataFrame([(1, [1.0, 2.0])], "idx INT, vec ARRAY<FLOAT>")
    for limit in (1 << 20, 0):
        ids = e.encode(rows, vocab, ["text_id"], broadcast_bytes=limit)
        means = e.mean_embedding(ids, vectors, ["text_id"], 2, broadcast_bytes=limit)
        assert nodes(means, "collect_list") == nodes(means, "posexplode") == nodes(ids, "Generate") == 0


def test_mean_of_long_and_odd_texts(spark, small_blocks):
    vectors = spark.createDataFrame([(i, [float(i), -0.5 * i]) for i in range(1, 40)], "idx INT, vec ARRAY<FLOAT>")
    texts = {i: [(i * j) % 50 for j in range(i % 31)] for i in range(120)} | {120: None, 121: [3] * 50_000 + [0] * 50_000}
    rows = spark.createDataFrame(list(texts.items()), "text_id BIGINT, ids ARRAY<INT>").repartition(3)
    for limit in (1 << 20, 0):
        got = {r.text_id: r.mean for r in e.mean_embedding(rows, vectors, ["text_id"], 2, broadcast_bytes=limit).collect()}
        for k, ids in texts.items():
            first = sum(i for i in ids or [] if i < 40) / max(len(ids or []), 1)
            assert got[k] == pytest.approx([first, -first / 2])


def test_no_row_and_no_known_word(spark):
    vocab = spark.createDataFrame([("a", 1, 0)], "word STRING, n BIGINT, idx BIGINT")
    rows = spark.createDataFrame([(1, ["x"]), (2, [None])], "text_id BIGINT, tokens ARRAY<STRING>")
    assert e.encode(rows.where(F.col("text_id") > 9), vocab, ["text_id"]).collect() == []
    assert {r.text_id: r.ids for r in e.encode(rows, vocab, ["text_id"]).collect()} == {1: [0], 2: [0]}
