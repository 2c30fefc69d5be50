"""The model catalogue and the training history."""

from __future__ import annotations

from pyspark.sql import functions as F

from penmark.functions import naming
from penmark.operators import history as h, registry as g
from penmark.plans import views as v
from penmark.plans.registry import query, rounded, shown_time
from penmark.plans.sql import rounded as sql_rounded, with_views


def models(spark, sf_dir):
    return g.catalogue(v.model_files(spark, sf_dir))


def _sql(columns: str, tail: str = "") -> str:
    return with_views(f"SELECT {columns} FROM models {tail}", "models")


_NAME = "name, model_type, accuracy, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, formatted_time, parsed"


def _parsed(df):
    return df.select(
        "name", "model_type", "accuracy", shown_time(F.col("timestamp")).alias("timestamp"), "formatted_time", "parsed"
    )


@query("parse_model_name", _sql(_NAME))
def parse_model_name(spark, sf_dir):
    return _parsed(models(spark, sf_dir))


@query("parse_model_name_bad_date", _sql(_NAME, "WHERE parsed AND timestamp IS NULL"))
def parse_model_name_bad_date(spark, sf_dir):
    return _parsed(models(spark, sf_dir).where("parsed AND timestamp IS NULL"))


@query("registry_size_mb", _sql("path, size, size_mb"))
def registry_size_mb(spark, sf_dir):
    return models(spark, sf_dir).select("path", "size", "size_mb")


@query("registry_basename", _sql("path, name"))
def registry_basename(spark, sf_dir):
    return v.model_files(spark, sf_dir).select("path", naming.base_name(F.col("path")).alias("name"))


@query("resolve_model_type", _sql("""path, given,
    CASE WHEN lower(coalesce(given, CASE WHEN parsed THEN lower(model_type) END, 'rnn')) IN ('lstm', 'rnn', 'bert')
         THEN lower(coalesce(given, CASE WHEN parsed THEN lower(model_type) END, 'rnn')) ELSE 'rnn' END AS resolved_type""",
    "JOIN (SELECT path AS p, CASE size % 3 WHEN 0 THEN 'LSTM' WHEN 1 THEN 'other' END AS given FROM model_files) ON p = path"))
def resolve_model_type(spark, sf_dir):
    files = v.model_files(spark, sf_dir)
    given = F.expr("CASE size % 3 WHEN 0 THEN 'LSTM' WHEN 1 THEN 'other' END")
    named = files.select("path", naming.base_name(F.col("path")).alias("name"), given.alias("given"))
    resolved = naming.resolve_type(F.col("model_type"), F.col("parsed"), F.col("given"))
    return naming.parse_model_name(named).select("path", "given", resolved.alias("resolved_type"))


CURRENT = "(SELECT path FROM models ORDER BY accuracy DESC, timestamp DESC NULLS LAST, path LIMIT 1)"


@query("registry_current", _sql(f"path, path = {CURRENT} AS is_current"))
def registry_current(spark, sf_dir):
    """The current model is the best one, as after start-up."""
    rows = models(spark, sf_dir)
    return g.mark_current(rows, g.best(rows).select("path").scalar()).select("path", "is_current")


@query("registry_listing", _sql(f"""name,
    CASE WHEN parsed THEN name || ' (' || size_mb || ' MB) - ' || model_type || ' ' || printf('%.1f%%', accuracy) || ' (' || formatted_time || ')'
         ELSE name || ' (' || size_mb || ' MB) - Unknown format' END AS line,
    CASE WHEN parsed THEN model_type || ' ' || accuracy || '% - ' ELSE '' END || name || ' (' || size_mb || ' MB)'
        || CASE WHEN path = {CURRENT} THEN ' [CURRENT]' ELSE '' END AS entry"""))
def registry_listing(spark, sf_dir):
    rows = models(spark, sf_dir)
    marked = g.mark_current(rows, g.best(rows).select("path").scalar())
    return g.listing(marked).select("name", "line", "entry")


@query("registry_ranked", _sql(
    "path, accuracy, row_number() OVER (ORDER BY accuracy DESC, timestamp DESC NULLS LAST, path) - 1 AS rank"))
def registry_ranked(spark, sf_dir):
    return g.ranked(models(spark, sf_dir)).select("path", "accuracy", "rank")


@query("registry_best", _sql("path, accuracy", "ORDER BY accuracy DESC, timestamp DESC NULLS LAST, path LIMIT 1"))
def registry_best(spark, sf_dir):
    return g.best(models(spark, sf_dir)).select("path", "accuracy")


@query("registry_find", with_views("""
    SELECT w.path, m.accuracy, CASE WHEN m.path IS NULL THEN 'Model not found: ' || w.path END AS error
    FROM (SELECT CASE WHEN size % 5 = 0 THEN path || '.bak' ELSE path END AS path FROM model_files) w
    LEFT JOIN models m ON m.path = w.path""", "models"))
def registry_find(spark, sf_dir):
    """Models asked for by path, some of which are gone."""
    files = v.model_files(spark, sf_dir)
    wanted = files.select(F.when(F.col("size") % 5 == 0, F.concat("path", F.lit(".bak"))).otherwise(F.col("path")).alias("path"))
    return g.find_models(models(spark, sf_dir), wanted).select("path", "accuracy", "error")


_CHOICES = {
    "accuracy": "coalesce(accuracy, 0) DESC", "time": "timestamp DESC NULLS LAST",
    "name": "name", "size": "coalesce(size_mb, 0) DESC",
}


@query("registry_sorted", with_views(" UNION ALL ".join(
    f"SELECT '{choice}' AS sort_by, path, row_number() OVER (ORDER BY {order}, path) - 1 AS rank FROM models"
    for choice, order in _CHOICES.items()), "models"))
def registry_sorted(spark, sf_dir):
    return g.ranked_each(models(spark, sf_dir))


@query("checkpoint_name", with_views("""
    SELECT run, epoch, run || '_' || round_even(val_acc * 100, 1) || '_' || strftime(saved_at, '%Y-%m-%d_%H-%M-%S') || '.pt' AS name
    FROM history""", "history"))
def checkpoint_name(spark, sf_dir):
    name = naming.checkpoint_name(F.col("run"), F.col("val_acc"), F.col("saved_at"))
    return v.history(spark, sf_dir).select("run", "epoch", name.alias("name"))


@query("epoch_loss", with_views(
    f"SELECT run, epoch, {sql_rounded('avg(batch_loss)', 9)} AS loss FROM batch_losses GROUP BY run, epoch", "batch_losses"))
def epoch_loss(spark, sf_dir):
    return h.epoch_loss(v.batch_losses(spark, sf_dir)).withColumn("loss", rounded(F.col("loss"), 9))


@query("best_checkpoints", with_views(f"""
    , kept AS (SELECT * FROM (SELECT *, max(val_acc) OVER (PARTITION BY run ORDER BY epoch
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM history) WHERE val_acc > coalesce(prev, 0))
    SELECT run, epoch, {sql_rounded('val_acc')} AS val_acc, epoch = max(epoch) OVER (PARTITION BY run) AS is_best FROM kept""",
    "history"))
def best_checkpoints(spark, sf_dir):
    kept = h.best_checkpoints(v.history(spark, sf_dir))
    return kept.select("run", "epoch", rounded(F.col("val_acc")).alias("val_acc"), "is_best")


@query("training_history", with_views(f"""
    SELECT run, epoch, round(0.0001 * power(0.5, floor(epoch / 3)), 12) AS lr,
        printf('Epoch [%d/%d] | Loss: %.4f | Train Acc: %.2f%% | Val Acc: %.2f%%', epoch + 1,
               max(epoch) OVER (PARTITION BY run) + 1, loss, train_acc * 100, val_acc * 100) AS line
    FROM history""", "history"))
def training_history(spark, sf_dir):
    lines = h.report(h.with_learning_rate(v.history(spark, sf_dir)))
    return lines.select("run", "epoch", F.round("lr", 12).alias("lr"), "line")
