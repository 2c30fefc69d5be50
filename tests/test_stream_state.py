"""Keyed state of the streaming curation: its own texts only, nothing read back, exact however late."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from penmark.operators import curate
from penmark.session import fresh_dir
from penmark.streaming.curate import STATE, curate_stream, read_curated_stream

SCHEMA = "pos long, text_id string, text string, user_id long, label int, created_at timestamp"


def deliver(spark, rows, landing, out, checkpoint):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
    query = curate_stream(spark.readStream.schema(SCHEMA).parquet(landing), out, checkpoint)
    query.awaitTermination()
    return query.lastProgress


def post(pos, text, label=0):
    return (pos, None if pos is None else str(pos), text, 1, label, None)


def test_late_and_out_of_order_deliveries_equal_the_batch_form(spark):
    rng = random.Random(7)
    landing, out, checkpoint = (fresh_dir(spark, n) for n in ("state-in", "state-out", "state-mark"))
    posts = [post(i, f" text {rng.randrange(60)} ", rng.choice([None, 0, 1])) for i in range(240)]
    posts += [post(1000 + i, None) for i in range(3)] + [post(2000, "  "), post(None, "text 5"), post(None, "no place")]
    rng.shuffle(posts)
    for part in (posts[:120], posts[120:200], posts[200:] + posts[:30]):
        deliver(spark, part, landing, out, checkpoint)
    columns = ["pos", "text_id", "text", "label"]
    whole = curate.curate_posts(spark.read.schema(SCHEMA).parquet(landing)).select(*columns)
    got = read_curated_stream(spark, out).select(*columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, whole.collect())) and got.count() > 50


def test_a_batch_touches_its_own_texts_and_reads_nothing_back(spark):
    landing, out, checkpoint = (fresh_dir(spark, n) for n in ("state-in", "state-out", "state-mark"))
    deliver(spark, [post(i, f"text {i}") for i in range(10, 510)], landing, out, checkpoint)
    moved = spark.read.parquet(f"{out}/batch=0").count()
    # Overwrite the stored rows: a batch that read them would now think every text new.
    spark.read.parquet(f"{out}/batch=0").limit(0).coalesce(1).write.mode("overwrite").parquet(f"{out}/batch=0-gone")
    spark.createDataFrame([], spark.read.parquet(f"{out}/batch=0-gone").schema).write.mode("overwrite").parquet(f"{out}/batch=0")
    progress = deliver(spark, [post(600, "text 20"), post(5, "text 30"), post(601, "new")], landing, out, checkpoint)
    state = progress["stateOperators"][0]
    assert moved == 500 and state["numRowsUpdated"] == 3 and state["numRowsTotal"] == 501
    assert any("rocksdb" in name.lower() for name in state["customMetrics"])
    rows = spark.read.parquet(f"{out}/batch=1").select("pos", "text").collect()
    assert sorted(map(tuple, rows)) == [(5, "text 30"), (601, "new")]
    assert deliver(spark, [post(600, "text 20")], landing, out, checkpoint)["stateOperators"][0]["numRowsUpdated"] == 1
    assert spark.read.parquet(f"{out}/batch=2").count() == 0


def test_session_settings_are_as_before(spark):
    name = next(iter(STATE))
    before = spark.conf.get(name, None)
    landing, out, checkpoint = (fresh_dir(spark, n) for n in ("state-in", "state-out", "state-mark"))
    deliver(spark, [post(1, "a")], landing, out, checkpoint)
    assert spark.conf.get(name, None) == before
    assert spark.read.parquet(out).where(F.col("text") == "a").count() == 1


def test_deliveries_are_written_in_one_pass_and_arrive_whole(spark):
    """A post in two deliveries is in both, one in none is in none; a delivery without posts leaves an empty landing."""
    from pyspark.sql import functions as F
    from penmark.session import fresh_dir
    from penmark.streaming.curate import arrive, deliver

    staged, landing = fresh_dir(spark, "test-staged"), fresh_dir(spark, "test-landing")
    posts = spark.range(20).select(F.col("id").alias("pos"), F.lit("x").alias("text")).repartition(2)
    deliver(posts, [F.col("pos") < 5, F.col("pos") % 2 == 0, F.lit(None).cast("boolean")], staged)
    got = []
    for i in range(3):
        arrive(spark, f"{staged}/delivery={i}", f"{landing}/{i}")
        rows = spark.read.schema(posts.schema).option("recursiveFileLookup", "true").parquet(landing).collect()
        got.append(sorted(r.pos for r in rows))
    assert got == [list(range(5)), *[sorted([*range(5), *range(0, 20, 2)])] * 2]
