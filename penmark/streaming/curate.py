"""Curate posts as they arrive."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from penmark.functions.ids import POST_SOURCE
from penmark.operators.curate import HUMAN, assign_canonical_id, default_label, drop_empty, normalise_text
from penmark.operators.dedup import keep_first

# State lives on the executors' disks; a commit uploads what a batch changed.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings for the time in which a stream starts; the stream keeps its own copy."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def deliver(posts: DataFrame, deliveries: list[Column], folder: str) -> None:
    """Write the posts of every delivery (a condition each; a post may be in several) to ``folder/delivery=i``, all in one pass over ``posts``.

    A task keeps one file open for each delivery, so rows are not sorted for the write and stay in their order."""
    held = F.array_compact(F.array(*[F.when(chosen, F.lit(i)) for i, chosen in enumerate(deliveries)]))
    rows = posts.withColumn("delivery", F.explode(held))
    with settings(posts.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(len(deliveries))}):
        rows.write.option("compression", "zstd").partitionBy("delivery").parquet(folder)


def arrive(spark: SparkSession, folder: str, landing: str) -> None:
    """A written delivery, if it has any post, appears in the landing folder at once and whole: it is moved, not copied."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (folder, landing))
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target.getParent())
    if files.exists(source) and not files.rename(source, target):
        raise OSError(f"{folder} could not be moved to {landing}")


def improvements(posts: DataFrame) -> DataFrame:
    """Of a stream of posts, the rows that are the first copy of their text so far and arrived in the current micro-batch.

    Keyed state: one entry per text, found by its SHA-256, holds the row with the smallest ``pos`` (null last, the
    first to arrive of equals). A micro-batch reads and writes the entries of its own texts only. A text whose first
    copy came in an earlier micro-batch gives no row. Needs update mode.
    """
    ready = posts.transform(normalise_text).transform(drop_empty).transform(default_label, HUMAN)
    columns = ready.columns
    order = F.struct(F.col("pos").isNull().alias("none"), F.col("pos").alias("pos"), F.current_timestamp().alias("arrived"))
    keyed = ready.select(F.unhex(F.sha2("text", 256)).alias("key"), F.struct(order.alias("order"), *columns).alias("row"))
    first = keyed.groupBy("key").agg(F.min_by("row", "row.order").alias("row"))
    # the time is that of the micro-batch, the same for all of its rows and when it is repeated
    fresh = first.where(F.col("row.order.arrived") == F.current_timestamp())
    return fresh.select(*[f"row.{c}" for c in columns]).transform(assign_canonical_id, POST_SOURCE)


def curate_stream(posts: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Curate all posts that have arrived, then stop. :func:`read_curated_stream` gives the table.

    Exact however late a post comes (no watermark): each micro-batch adds the texts that are new or that now have an
    earlier ``pos``, as its state says; it never reads what is stored. A micro-batch writes its own folder and its
    state is versioned, so repeating it changes nothing. The number of state partitions is that of shuffle
    partitions when ``checkpoint`` is first used.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/batch={batch_id}")

    with settings(posts.sparkSession, STATE):
        return (
            improvements(posts).writeStream.foreachBatch(handle)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def read_curated_stream(spark: SparkSession, out: str) -> DataFrame:
    """The first copy of every text that has arrived: what the batch form gives for the same posts."""
    return spark.read.parquet(out).drop("batch").transform(keep_first, ["text"], "pos")
