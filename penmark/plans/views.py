"""Inputs of the registered queries, derived by Spark from the given tables.

Each view has a twin of the same name in ``sql.py``. A view decorates texts only with
values that equal texts share, so that copies stay copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from penmark.functions import tokens as tk

TURN_BITS = 24  # a conversation's turns take the low bits of its positions


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def turn_position():
    return F.col("conv_id") * (1 << TURN_BITS) + F.col("turn")


def posts_of(events: DataFrame, docs: DataFrame) -> DataFrame:
    """Raw posts: every event carries the text of a document; errors are blank and views
    are padded with Unicode whitespace."""
    total = docs.agg(F.count(F.lit(1))).scalar()
    text = (
        F.when(F.col("event_type") == "error", F.lit("\u00a0  "))
        .when(F.col("event_type") == "view", F.concat(F.lit("\u2003 "), "text", F.lit("\n")))
        .otherwise(F.col("text"))
    )
    keyed = events.withColumn("doc_id", F.col("event_id") % total)
    return keyed.join(docs.select("doc_id", "text"), "doc_id").select(
        F.col("event_id").alias("pos"),
        F.col("event_id").alias("text_id"),
        text.alias("text"),
        "user_id",
        F.when(F.col("event_type") != "click", F.lit(0)).alias("label"),
        F.col("ts").alias("created_at"),
    )


def raw_posts(spark, sf_dir):
    return posts_of(table(spark, sf_dir, "events"), documents(spark, sf_dir))


def raw_generated(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    return turns.select(
        turn_position().alias("pos"),
        F.concat_ws(":", "conv_id", "turn").alias("text_id"),
        "text",
        F.when(F.col("turn") != 1, F.lit(1)).alias("label"),
    )


def user_turns(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").where("role = 'user'")
    return turns.select(turn_position().alias("pos"), "text", F.lit(0).alias("label"))


def human_corpus(spark, sf_dir):
    """User turns that a Latin-1 file can hold."""
    return user_turns(spark, sf_dir).where(~F.col("text").rlike(r"[^\x{00}-\x{ff}]"))


def labelled_corpus(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return docs.join(labels, "doc_id").select(F.col("doc_id").alias("pos"), "text", "label")


def polar(spark, sf_dir):
    label = F.when(F.col("lang") == "en", 0).otherwise(1)
    return documents(spark, sf_dir).select("doc_id", "text", label.alias("label"), "source")


def odd_labels(spark, sf_dir):
    """Labels 0, 1, 2 and null by language."""
    label = F.expr("CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 END")
    return documents(spark, sf_dir).select("doc_id", "text", label.alias("label"))


def tweety(spark, sf_dir):
    """Documents dressed as posts, and added rows without text."""
    size = F.length("text")
    gap = F.when(size % 7 == 0, F.lit("a\u00a0b")).otherwise("")
    mark = F.when((F.col("label") == 1) & (size % 3 == 0), F.lit("q§—q ")).otherwise("")
    dressed = F.concat(
        F.lit("  @Bob_"), (size % 50).cast("string"), F.lit(" #Tag http://x.y/"), size.cast("string"),
        F.lit(" 😀☕️ "), gap, mark, "text", F.lit("\t HTTP://Z "),
    )
    full = polar(spark, sf_dir).select("doc_id", dressed.alias("text"), "label")
    none = polar(spark, sf_dir).where("doc_id % 11 = 0").select(
        (-1 - F.col("doc_id")).alias("doc_id"), F.lit(None).cast("string").alias("text"), "label")
    return full.unionByName(none)


def tokens(spark, sf_dir):
    words = tk.alpha_tokens(F.col("text"))
    return polar(spark, sf_dir).select(F.col("doc_id").alias("text_id"), words.alias("tokens"), "label")


def list_literals(spark, sf_dir):
    """The token table as stored: a list literal and its target."""
    return tokens(spark, sf_dir).select(
        "text_id", tk.list_literal(F.col("tokens")).alias("text"), (1 - F.col("label")).alias("human_wrote")
    )


def turns(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        turn_position().alias("text_id"), "text", "role"
    )


def logits(spark, sf_dir):
    def part(start):
        dims = F.slice("embedding", start, 32)
        return F.aggregate(dims, F.lit(0.0), lambda acc, x: acc + x.cast("double"))

    return table(spark, sf_dir, "embeddings").select(
        "vec_id", part(1).alias("z0"), part(33).alias("z1"), (F.col("label") % 2).alias("target")
    )


def word_vectors(spark, sf_dir):
    """Vectors by index; index 0 is the padding slot and has none."""
    return table(spark, sf_dir, "embeddings").select(
        (F.col("vec_id") + 1).cast("int").alias("idx"), F.col("embedding").alias("vec")
    )


def requests(spark, sf_dir):
    """One request per turn: batches from users, single texts from assistants, and broken
    ones from the system turns."""
    lines = F.split(F.concat("text", F.lit("\n \nend")), "\n")
    broken = F.expr(
        """CASE length(text) % 5
             WHEN 0 THEN text WHEN 1 THEN '{"texts":[]}' WHEN 2 THEN '{"texts":"one"}'
             WHEN 3 THEN '{}' ELSE '{"text":"   "}' END"""
    )
    body = (
        F.when(F.col("role") == "user", F.to_json(F.struct(lines.alias("texts"))))
        .when(F.col("role") == "assistant", F.to_json(F.struct("text")))
        .otherwise(broken)
    )
    return table(spark, sf_dir, "conversations").select(turn_position().alias("request_id"), body.alias("body"))


def model_files(spark, sf_dir):
    """Model files named after events: readable names, names with month 13, other names."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    tenths = F.floor(cents / 10)
    kind = F.expr("CASE event_type WHEN 'click' THEN 'lstm' WHEN 'view' THEN 'rnn' ELSE 'bert' END")
    good = F.date_format("ts", "yyyy-MM-dd_HH-mm-ss")
    bad = F.concat(F.date_format("ts", "yyyy"), F.lit("-13-"), F.date_format("ts", "dd_HH-mm-ss"))
    stamp = F.when(F.col("event_type") == "signup", bad).otherwise(good)
    shown = F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))
    name = F.when(
        F.col("event_type") == "error", F.concat(F.lit("run"), F.col("event_id").cast("string"), F.lit(".pt"))
    ).otherwise(F.concat(F.concat_ws("_", kind, shown, stamp), F.lit(".pt")))
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("model_save/"), F.col("event_id").cast("string"), F.lit("/"), name).alias("path"),
        (F.col("event_id") * 4096 + cents * 1000).alias("size"),
        F.col("ts").alias("modified"),
    )


def batch_losses(spark, sf_dir):
    """Every event is one batch of the run of its type, in the epoch of its day."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("run"),
        F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).alias("epoch"),
        F.col("value").alias("batch_loss"),
        F.col("ts").alias("saved_at"),
    )


def history(spark, sf_dir):
    """Losses have two decimals, so they are summed as whole cents: reports with few
    decimals must not depend on the order of a floating-point sum."""
    loss = F.col("batch_loss")
    cents = F.sum(F.round(loss * 100).cast("bigint")).cast("double")
    mean = cents / (F.count(loss) * 100)
    return batch_losses(spark, sf_dir).groupBy("run", "epoch").agg(
        mean.alias("loss"),
        (F.avg(F.sqrt(loss)) / 20).alias("train_acc"),
        (mean / 100).alias("val_acc"),
        F.max("saved_at").alias("saved_at"),
    )
