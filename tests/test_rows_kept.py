"""No operator loses, wipes or mixes rows: nulls in keys and positions, odd files, late posts."""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import functions as F

from penmark import schemas
from penmark.operators import clean, curate, history, positions, registry, score, split
from penmark.operators.dedup import keep_first
from penmark.session import fresh_dir
from penmark.sources import readers as r
from penmark.streaming.curate import curate_stream, read_curated_stream

KEYS = [(1, "a"), (None, "b"), (70_000, "c"), (None, "d"), (None, "d"), (-5, "e")]


def test_null_keys_keep_their_rows(spark):
    rows = spark.createDataFrame(KEYS, "id long, text string")
    assert sorted(x.batch_id for x in positions.batches(rows, "id", 2).collect()) == [0, 0, 1, 1, 2, 2]
    assert sorted(x.place for x in positions.seeded_order(rows, "id", "place").collect()) == list(range(6))
    assert split.split_exact(rows, "id").count() == 6


def test_main_table_keeps_rows_without_position(spark):
    rows = spark.createDataFrame([(t, 0, i) for i, t in KEYS], "text string, label int, pos long")
    main = curate.merge_main([curate.placed(rows), curate.placed(rows)]).collect()
    assert sorted(x.text_id for x in main) == list(range(12))


def test_keep_first_with_null_order_keeps_whole_rows(spark):
    rows = spark.createDataFrame(
        [("x", None, "p", 1), ("x", None, "q", 2), ("y", None, "r", 3), ("y", 4, "s", 4), ("z", 9, None, None)],
        "text string, pos long, who string, label int")
    got = {x.text: (x.pos, x.who, x.label) for x in keep_first(rows, ["text"], "pos").collect()}
    assert got["x"] in [(None, "p", 1), (None, "q", 2)] and got["y"] == (4, "s", 4) and got["z"] == (9, None, None)


def test_cleaning_keeps_a_null_id(spark):
    rows = spark.createDataFrame([("a b", 0, None), ("c", 1, 2)], "text string, label int, text_id long")
    assert clean.clean_corpus(rows).count() == 2


def test_labelled_csv_by_name(spark):
    path = fresh_dir(spark, "csv")
    spark.createDataFrame([("7", "1", "one, two"), ("8", "0", "three")], "id string, label string, text string").write.options(
        header="true", escape='"').csv(path)
    assert sorted((x.text, x.label) for x in r.read_labelled_csv(spark, path).collect()) == [("one, two", 1), ("three", 0)]


def test_placed_records(spark):
    path = fresh_dir(spark, "json")
    spark.createDataFrame([(f"t{i:02}",) for i in range(20)], "text string").repartitionByRange(3, "text").sortWithinPartitions("text").write.json(path)
    got = r.read_placed_records(spark, path, schemas.RAW_GENERATED).orderBy("pos").collect()
    assert [(x.pos, x.text) for x in got] == [(i, f"t{i:02}") for i in range(20)]
    made = curate.curate_generated(r.read_placed_records(spark, path, schemas.RAW_GENERATED))
    assert made.select("text_id").distinct().count() == 20


def test_missing_predictions_and_accuracies(spark):
    rows = spark.createDataFrame([(1, 1), (None, 1), (0, 1)], "prediction int, target int")
    assert tuple(score.accuracy(rows).first()) == (1, 3, 1 / 3)
    runs = spark.createDataFrame([("a", 0, math.nan), ("a", 1, 0.9), ("a", 2, 0.8)], "run string, epoch int, val_acc double")
    assert [(x.epoch, x.is_best) for x in history.best_checkpoints(runs).collect()] == [(1, True)]


def test_models_by_path(spark):
    models = spark.createDataFrame([("m/a.pt", 1.0)], "path string, accuracy double")
    wanted = spark.createDataFrame([("m/a.pt",), ("m/b.pt",)], "path string")
    got = {x.path: (x.accuracy, x.error) for x in registry.find_models(models, wanted).collect()}
    assert got == {"m/a.pt": (1.0, None), "m/b.pt": (None, "Model not found: m/b.pt")}


def test_late_posts_of_a_stream(spark):
    landing, out, checkpoint = (fresh_dir(spark, n) for n in ("in", "out", "mark"))
    schema = "pos long, text_id string, text string, user_id long, label int, created_at timestamp"
    deliveries = [
        [(5, "5", "same", 1, 0, datetime(2024, 1, 3)), (6, "6", " once ", 1, None, datetime(2024, 1, 3, 5))],
        [(2, "2", "same", 2, 0, datetime(2024, 1, 1)), (7, "7", "late", 2, 0, datetime(2023, 12, 1))],
        [(9, "9", "late", 3, 0, datetime(2024, 2, 1)), (10, "10", "  ", 3, 0, datetime(2024, 2, 1)), (5, "5", "same", 1, 0, datetime(2024, 1, 3))],
    ]
    for rows in deliveries:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        curate_stream(spark.readStream.schema(schema).parquet(landing), out, checkpoint).awaitTermination()
    got = sorted(map(tuple, read_curated_stream(spark, out).select("pos", "text_id", "text", "label").collect()))
    whole = curate.curate_posts(spark.read.schema(schema).parquet(landing)).select("pos", "text_id", "text", "label")
    assert got == sorted(map(tuple, whole.collect())) and [x[0] for x in got] == [2, 6, 7]
    assert spark.read.parquet(out).where(F.col("batch") == 2).count() == 0
