"""Fitting, choosing and using models. Fitted weights differ between engines, so these
queries have no SQL check; tests cover their rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from penmark.functions import tokens as tk
from penmark.operators import fit, score as s, train
from penmark.operators.encode import token_targets
from penmark.operators.history import best_checkpoints
from penmark.operators.split import split_by_hash
from penmark.operators.word_vectors import train_vectors
from penmark.plans import views as v
from penmark.plans.registry import query
from penmark.plans.sql import with_views
from penmark.session import discard, fresh_dir, stored


def labelled_tokens(spark, sf_dir):
    rows = token_targets(v.tokens(spark, sf_dir)).withColumn("human_wrote", F.col("human_wrote").cast("double"))
    return split_by_hash(rows, "text_id")


def _trained(spark, sf_dir, family="tfidf_lr", **settings):
    rows = labelled_tokens(spark, sf_dir).where("split = 'train'").persist()
    try:
        return fit.fit(rows, family, **settings)
    finally:
        rows.unpersist()


_KEPT: dict[tuple, tuple] = {}


def _kept(spark, sf_dir, family="tfidf_lr"):
    """The model of this table, fitted and saved once per application and loaded from its folder ever after, and the word counts it was
    fitted on."""
    key = (spark.sparkContext.applicationId, sf_dir, family)
    if key not in _KEPT:
        model, rows = fit.fit_hashed(labelled_tokens(spark, sf_dir), family)
        _KEPT[key] = fit.save(model, fresh_dir(spark, "models"), family), rows
    path, rows = _KEPT[key]
    return fit.load(path), rows


def _vectors(spark, sf_dir):
    rows, path = stored(labelled_tokens(spark, sf_dir).select("text_id", "tokens"), "tokens")
    try:
        return train_vectors(rows)
    finally:
        discard(spark, path)


@query("train_word_vectors")
def train_word_vectors(spark, sf_dir):
    return _vectors(spark, sf_dir)[0].select("word", "vec")


@query("word_vector_table", with_views("""
    SELECT word, n, 32 AS dims, true AS finite FROM (
        SELECT word, count(*) AS n FROM (SELECT unnest(tokens) AS word FROM tokens) GROUP BY word) WHERE n >= 5""", "tokens"))
def word_vector_table(spark, sf_dir):
    """What trained vectors say whatever their values: every word that is frequent enough, once, with a whole finite vector."""
    vectors, _ = _vectors(spark, sf_dir)
    finite = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < 1e6))
    return vectors.select("word", "n", F.size("vec").alias("dims"), finite.alias("finite"))


@query("fit_classifier")
def fit_classifier(spark, sf_dir):
    """The loss curve of one fit."""
    losses = fit.loss_curve(_trained(spark, sf_dir))
    return spark.createDataFrame(list(enumerate(losses)), "epoch INT, loss DOUBLE")


@query("model_families")
def model_families(spark, sf_dir):
    """Accuracy of each family on the validation split."""
    rows, path = stored(labelled_tokens(spark, sf_dir).where("split IN ('train', 'val')"), "tokens")
    found = []
    try:
        for family, accuracy in fit.compare_families(rows, sorted(fit.FAMILIES)):
            r = accuracy.first()
            found.append((family, r["correct"], r["total"], r["accuracy"]))
    finally:
        discard(spark, path)
    return spark.createDataFrame(sorted(found), "family STRING, correct BIGINT, total BIGINT, accuracy DOUBLE")


SETTINGS = [("tfidf_lr", {"step": 0.1}), ("tfidf_lr", {"step": 0.01}), ("tfidf_lr", {"step": 1.0})]


@query("select_best_run")
def select_best_run(spark, sf_dir):
    _, tried = fit.select_best(labelled_tokens(spark, sf_dir), SETTINGS)
    return fit.kept_runs(spark.createDataFrame(tried, "family STRING, epoch INT, val_acc DOUBLE"))


@query("test_accuracy")
def test_accuracy(spark, sf_dir):
    """One pass over all splits."""
    model, rows = _kept(spark, sf_dir)
    return fit.evaluate_hashed(rows, model, by=["split"])


def _scored(df, model):
    ready = df.withColumn("tokens", tk.tokenize(F.col("text")))
    return fit.score(ready, model).drop("tokens")


@query("score_texts")
def score_texts(spark, sf_dir):
    return _scored(v.turns(spark, sf_dir), _kept(spark, sf_dir)[0])


@query("score_batch")
def score_batch(spark, sf_dir):
    rows = s.explode_batch(v.requests(spark, sf_dir), "body", ["request_id"])
    return _scored(rows.where("error IS NULL").drop("error"), _kept(spark, sf_dir)[0])


EPOCHS, RATE = 4, 0.01


@query("train_epochs", with_views(f"""
    SELECT CAST(epoch AS INTEGER) AS epoch, {RATE} * 0.5 ** (epoch // 3) AS lr, true AS bounded, true AS kept_right, trained
    FROM range({EPOCHS}) AS t(epoch), (SELECT count(*) AS trained FROM tokens
         WHERE CAST('0x' || substr(md5('42:' || text_id), 1, 8) AS BIGINT) % 100 < 70)""", "tokens"))
def train_epochs(spark, sf_dir):
    """Mini-batch training: per epoch its rate, whether loss and accuracies are possible values, and whether it was kept as the
    rule of best checkpoints over the emitted history says."""
    ready = train.hashed(labelled_tokens(spark, sf_dir))
    path = fresh_dir(spark, "slots")
    ready.select("split", "human_wrote", "slots_of_text").write.parquet(path)
    rows = spark.read.schema("split STRING, human_wrote DOUBLE, slots_of_text ARRAY<INT>").parquet(path)
    model, _ = train.train(rows, EPOCHS, RATE, folder=fresh_dir(spark, "epochs"))
    history = spark.createDataFrame(
        [(*h, h[1] in model.kept) for h in model.history],
        "run STRING, epoch INT, loss DOUBLE, train_acc DOUBLE, val_acc DOUBLE, lr DOUBLE, kept BOOLEAN",
    )
    by_rule = best_checkpoints(history).select("epoch", F.lit(True).alias("best"))
    bounded = F.col("loss").between(0, 100) & F.col("train_acc").between(0, 1) & F.col("val_acc").between(0, 1)
    trained = rows.where("split = 'train'").agg(F.count(F.lit(1))).scalar()
    return history.join(by_rule, "epoch", "left").select(
        "epoch", "lr", bounded.alias("bounded"), (F.col("kept") == F.col("best").isNotNull()).alias("kept_right"), trained.alias("trained")
    )


@query("test_totals", with_views("""
    SELECT CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'val' ELSE 'test' END AS split, count(*) AS total, true AS adds_up
    FROM (SELECT CAST('0x' || substr(md5('42:' || text_id), 1, 8) AS BIGINT) % 100 AS b FROM tokens) GROUP BY ALL""", "tokens"))
def test_totals(spark, sf_dir):
    """What an evaluation says whatever the weights: every row counted once, the ratio that of its counts."""
    found = test_accuracy(spark, sf_dir)
    adds_up = (F.col("correct") <= F.col("total")) & (F.abs(F.col("accuracy") - F.col("correct") / F.col("total")) < 1e-12)
    return found.select("split", "total", adds_up.alias("adds_up"))


@query("score_saved", with_views("SELECT text_id, true AS in_range, true AS agrees FROM turns", "turns"))
def score_saved(spark, sf_dir):
    """Fit once, keep the model, load it and score: confidence and label must fit the prediction."""
    path = fit.save(_trained(spark, sf_dir), fresh_dir(spark, "models"), "tfidf_lr")
    scored = _scored(v.turns(spark, sf_dir), fit.load(path))
    named = F.when(F.col("prediction") == 1, "Human-Written").otherwise("AI-Generated")
    return scored.select("text_id", F.col("confidence").between(0.5, 1).alias("in_range"), (F.col("label") == named).alias("agrees"))
