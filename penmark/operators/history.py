"""Training history: losses, learning rates, kept checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from penmark.functions.scoring import fixed, percent

# The report line, the start rate and its step schedule.
REPORT_LINE = "Epoch [%d/%d] | Loss: %s | Train Acc: %s | Val Acc: %s"
LEARNING_RATE = 1e-4
STEP_EPOCHS = 3
STEP_FACTOR = 0.5


def epoch_loss(batch_losses: DataFrame) -> DataFrame:
    """Mean of the batch losses of each epoch."""
    return batch_losses.groupBy("run", "epoch").agg(F.avg("batch_loss").alias("loss"))


def with_learning_rate(history: DataFrame, start: float = LEARNING_RATE) -> DataFrame:
    """Rate in force during an epoch (numbered from 0)."""
    steps = F.floor(F.col("epoch") / STEP_EPOCHS)
    return history.withColumn("lr", F.lit(start) * F.pow(F.lit(STEP_FACTOR), steps))


def best_checkpoints(history: DataFrame) -> DataFrame:
    """Epochs that beat every earlier one of their run, with whether each is the last such.

    An accuracy that is no number counts as 0.
    """
    history = history.withColumn("val_acc", F.nanvl(F.col("val_acc").cast("double"), F.lit(0.0)))
    run = Window.partitionBy("run").orderBy("epoch")
    before = F.max("val_acc").over(run.rowsBetween(Window.unboundedPreceding, -1))
    kept = history.withColumn("_before", F.coalesce(before, F.lit(0.0))).where("val_acc > _before")
    last = F.max("epoch").over(Window.partitionBy("run")) == F.col("epoch")
    return kept.drop("_before").withColumn("is_best", last)


def report(history: DataFrame) -> DataFrame:
    """One line per epoch: loss with four decimals, accuracies in percent with two."""
    epochs = F.max("epoch").over(Window.partitionBy("run")) + 1
    line = F.format_string(
        REPORT_LINE, F.col("epoch") + 1, epochs, fixed(F.col("loss"), 4),
        percent(F.col("train_acc"), 2), percent(F.col("val_acc"), 2),
    )
    return history.withColumn("line", line)
