"""Classifiers with Spark ML, over hashed words or trained word vectors."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.base import Transformer
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from penmark.functions.ids import SEED
from penmark.functions.scoring import argmax, class_name
from penmark.operators.history import best_checkpoints
from penmark.operators.score import accuracy
from penmark.operators.word_vectors import WordVectors, train_vectors
from penmark.session import discard, fresh_dir, materialise, stored

TARGET = "human_wrote"


def train_word_vectors(
    df: DataFrame, dims: int = 32, min_count: int = 5, epochs: int = 1, seed: int = SEED, parts: int | None = None, key: str = "text_id"
) -> DataFrame:
    """``word, vec`` of a token table, trained in ``parts`` blocks of words (as many as the vocabulary needs)."""
    vectors, _ = train_vectors(df, key, dims, min_count, epochs, blocks=parts, seed=seed)
    return vectors.select("word", "vec")


def _tfidf_lr(epochs: int, step: float, seed: int, slots: int) -> Pipeline:
    # Hashing needs no vocabulary, so the driver holds ``slots`` weights whatever the corpus.
    return Pipeline(stages=[
        HashingTF(inputCol="tokens", outputCol="counts", numFeatures=slots),
        IDF(inputCol="counts", outputCol="features"),
        LogisticRegression(labelCol=TARGET, maxIter=epochs, regParam=step),
    ])


def _w2v_lr(epochs: int, step: float, seed: int, slots: int) -> Pipeline:
    return Pipeline(stages=[
        WordVectors(seed=seed),
        LogisticRegression(labelCol=TARGET, maxIter=epochs, regParam=step),
    ])


def _w2v_mlp(epochs: int, step: float, seed: int, slots: int) -> Pipeline:
    return Pipeline(stages=[
        WordVectors(seed=seed),
        MultilayerPerceptronClassifier(
            labelCol=TARGET, layers=[32, 16, 2], maxIter=epochs, stepSize=step, solver="gd", seed=seed
        ),
    ])


FAMILIES = {"tfidf_lr": _tfidf_lr, "w2v_lr": _w2v_lr, "w2v_mlp": _w2v_mlp}


def classifier(
    family: str, epochs: int = 10, step: float = 1e-2, seed: int = SEED, slots: int = 2**18
) -> Pipeline:
    """An unfitted text classifier. ``step`` is the penalty of the regressions and the
    learning rate of the network; ``slots`` the hash slots of words. Families on word
    vectors need ``text_id``, one value a text."""
    if family not in FAMILIES:
        raise ValueError(f"unknown model family {family!r}; one of {sorted(FAMILIES)}")
    return FAMILIES[family](epochs, step, seed, slots)


def fit(df: DataFrame, family: str, **settings) -> Model:
    return classifier(family, **settings).fit(df)


def fit_each(df: DataFrame, families: list[str], **settings) -> Iterator[tuple[str, Model]]:
    """Each family with its model, all on the same rows. Word vectors are trained once for all families that begin with them, and the
    features made of them are stored."""
    vectors = ready = None
    for family in families:
        whole = classifier(family, **settings)
        first, *rest = whole.getStages()
        if not isinstance(first, WordVectors):
            yield family, whole.fit(df)
            continue
        if vectors is None:
            vectors = first.fit(df)
            features = vectors.transform(df).select(TARGET, "features")
            path = fresh_dir(df.sparkSession, "features")
            features.write.parquet(path)
            ready = df.sparkSession.read.schema(features.schema).parquet(path)
        yield family, PipelineModel([vectors, *Pipeline(stages=rest).fit(ready).stages])


def fit_hashed(df: DataFrame, family: str = "tfidf_lr", **settings) -> tuple[PipelineModel, DataFrame]:
    """A model of hashed words fitted on the ``train`` rows, and the stored word counts of all rows: tokens are made and hashed once, for
    the fit and for every evaluation by :func:`evaluate_hashed`."""
    first, *rest = classifier(family, **settings).getStages()
    if not isinstance(first, HashingTF):
        raise ValueError(f"model family {family!r} does not begin with hashed words")
    rows = materialise(first.transform(df).select("split", TARGET, first.getOutputCol()))
    model = Pipeline(stages=rest).fit(rows.where("split = 'train'"))
    return PipelineModel([first, *model.stages]), rows


def compare_families(df: DataFrame, families: list[str], **settings) -> Iterator[tuple[str, DataFrame]]:
    """Each family with its accuracy on ``val`` after a fit on ``train``. What families begin with alike (hashed words; word vectors trained on
    ``train``, and the means of every text) is made once for the fits and the evaluations, and stored as long as it is read: take each
    accuracy before the next family. Further splits are left out."""
    df = df.where("split IN ('train', 'val')")
    stages = {family: classifier(family, **settings).getStages() for family in families}
    order = sorted(stages, key=lambda f: type(stages[f][0]).__name__)  # families that begin alike one after the other
    made, rows, path = None, None, None
    for family in order:
        first, *rest = stages[family]
        if type(first) is not made:
            if path:
                discard(df.sparkSession, path)
            if isinstance(first, WordVectors):
                ready = first.fit(df.where("split = 'train'")).transform(df).select("split", TARGET, "features")
            else:
                ready = first.transform(df).select("split", TARGET, first.getOutputCol())
            rows, path = stored(ready, "features")
            made = type(first)
        model = Pipeline(stages=rest).fit(rows.where("split = 'train'"))
        yield family, evaluate(rows.where("split = 'val'"), model)
    if path:
        discard(df.sparkSession, path)


def evaluate_hashed(rows: DataFrame, model: PipelineModel, by: list[str] | None = None) -> DataFrame:
    """:func:`evaluate` for stored word counts."""
    return evaluate(rows, PipelineModel(model.stages[1:]), by)


def save(model: PipelineModel, folder: str, name: str) -> str:
    """Keep a fitted model under its checkpoint name; the catalogue lists it by that name."""
    path = f"{folder}/{name}"
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def loss_curve(model: Model) -> list[float]:
    """Objective after each epoch, as the last stage recorded it."""
    return [float(x) for x in model.stages[-1].summary.objectiveHistory]


def score(df: DataFrame, model: Transformer) -> DataFrame:
    """Prediction, confidence and class name from a fitted model's probabilities."""
    probability = vector_to_array("probability")
    scored = model.transform(df).withColumn("_p", probability)
    return (
        scored.withColumn("prediction", argmax(F.col("_p")))
        .withColumn("confidence", F.array_max("_p"))
        .withColumn("label", class_name(F.col("prediction")))
        .drop("_p", "probability", "rawPrediction", "features", "counts")
    )


def evaluate(df: DataFrame, model: Transformer, by: list[str] | None = None) -> DataFrame:
    """Accuracy of a fitted model; all splits in one job with ``by=['split']``."""
    return accuracy(score(df, model).withColumn("target", F.col(TARGET)), by)


def select_best(df: DataFrame, settings: list[tuple[str, dict]]) -> tuple[Model, list[tuple]]:
    """Fit every setting on ``train``; keep the one that is best on ``val``.

    A later setting wins only if it is strictly better. Returns the model and one
    ``(run, epoch, val_acc)`` row per setting.
    """
    train = df.where("split = 'train'").persist()
    val = df.where("split = 'val'").persist()
    best, best_acc, tried = None, 0.0, []
    try:
        for i, (family, params) in enumerate(settings):
            model = fit(train, family, **params)
            acc = evaluate(val, model).first()["accuracy"] or 0.0
            tried.append((family, i, float(acc)))
            if best is None or acc > best_acc:
                best, best_acc = model, acc
    finally:
        train.unpersist()
        val.unpersist()
    return best, tried


def kept_runs(tried: DataFrame) -> DataFrame:
    """Of the tried settings in order, those that beat all before them."""
    return best_checkpoints(tried.withColumn("run", F.lit("all")))
