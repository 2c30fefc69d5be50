"""What word vectors move: packed pairs, numbered texts, no shuffle files left behind."""

from __future__ import annotations

import random
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from penmark.operators import encode as e, word_vectors as wv
from penmark.session import discard, stored


def test_columns_come_back_as_packed():
    pack, unpack = wv._packing()
    for columns in ([[0, 1, 255, 256]], [[5, 1 << 40, 0], [1, 2, (1 << 62) + 3]], [[], []]):
        assert [x.tolist() for x in unpack(pack(*(np.array(c, np.int64) for c in columns)))] == columns


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_packed_pairs_are_those_of_the_window(spark, monkeypatch, parts):
    monkeypatch.setattr(wv, "COUNTED", 40)
    monkeypatch.setattr(wv, "PIECE", 7)
    rng = random.Random(parts)
    texts = [[rng.choice([0, 0, 1, 1, 1, 2, 3, 5, 8, 13]) for _ in range(n)] for n in (0, 1, 2, 30, 31, 200)] + [None]
    want = Counter()
    for ids in texts:
        known = [x - 1 for x in ids or [] if x]
        for p in range(len(known)):
            for q in range(p + 1, min(p + 4, len(known))):
                want[known[p], known[q]] += 1
                want[known[q], known[p]] += 1
    rows = spark.createDataFrame([(x,) for x in texts], "ids ARRAY<INT>").repartition(3)
    found = wv._tallied(rows, 3, 13, 4)
    assert found.agg(F.sum("pairs")).first()[0] == len({frozenset(p) for p in want})
    got = wv._in_cells(found, 13, 4, parts).collect()
    each = [(r.x * parts + r.i, r.y * parts + (r.i + r.stratum) % parts) for r in got]
    assert len(set(each)) == len(each) and dict(zip(each, (r.n for r in got))) == want


def test_a_round_gets_its_pairs_in_the_order_of_their_hash(spark, monkeypatch):
    df = spark.createDataFrame([(1, [chr(97 + i * i % 23) for i in range(120)])], "text_id BIGINT, tokens ARRAY<STRING>")
    whole = wv._round

    def checked(*args):
        run, epoch = whole(*args), args[-1]

        def look(batches):
            def each():
                before = None
                for batch in batches:
                    if batch.column("kind")[0].as_py() == 2:
                        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                            if before is not None and place[x, y, epoch] < before:
                                raise ValueError("order")
                            before = place[x, y, epoch]
                    yield batch

            return run(each())

        return look

    three = spark.range(40).crossJoin(spark.range(40).withColumnRenamed("id", "y")).crossJoin(spark.range(2).withColumnRenamed("id", "z"))
    code = F.xxhash64(*(F.col(c).cast("int") for c in ("id", "y", "z")))
    place = {(r.id, r.y, r.z): r.h for r in three.withColumn("h", code).collect()}
    monkeypatch.setattr(wv, "_round", checked)
    assert wv.train_vectors(df, dims=4, min_count=1, epochs=2, blocks=2)[0].count() == 12


def test_encoding_reads_its_texts_once(spark):
    """Texts are stored as numbers of their block's words; what fills the arrays makes no token again."""
    rows = spark.createDataFrame([(1, "a b a"), (2, None)], "text_id BIGINT, text STRING").withColumn("tokens", F.split("text", " "))
    vocab = spark.createDataFrame([("a", 2, 0)], "word STRING, n BIGINT, idx BIGINT")
    found = e.encode(rows, vocab, ["text_id"])
    assert "split(" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {r.text_id: r.ids for r in found.collect()} == {1: [1, 0, 1], 2: []}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    local = Path(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()[0])
    shuffles = lambda: {p.name for p in local.rglob("shuffle_*.data")}
    before = shuffles()
    rows, path = stored(spark.range(1000).repartition(7).withColumn("k", F.col("id") % 3).groupBy("k").count(), "test")
    for _ in range(50):  # files go in the background
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before and rows.count() == 3
    discard(spark, path)
    assert not Path(path.removeprefix("file:")).exists()


def test_word_vectors_read_stored_tokens(spark, sf_dir, monkeypatch):
    """No cache of tokens, and the stored ones go when the vectors are there."""
    from penmark.plans import QUERIES, training

    seen, whole = [], training.train_vectors
    monkeypatch.setattr(training, "train_vectors", lambda df: seen.append((df._jdf.queryExecution().optimizedPlan().toString(), df.inputFiles())) or whole(df))
    assert QUERIES["train_word_vectors"](spark, sf_dir).columns == ["word", "vec"]
    (plan, files), = seen
    assert "InMemoryRelation" not in plan and "regexp" not in plan
    assert files and not any(Path(f.removeprefix("file://")).exists() for f in files)
