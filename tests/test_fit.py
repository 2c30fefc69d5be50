"""Fitting with Spark ML on a separable fixture."""

from __future__ import annotations

import random

import pytest

from penmark.operators import fit
from penmark.operators.split import split_by_hash
from penmark.session import fresh_dir


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    words = {0.0: ["moreover", "thus", "notably"], 1.0: ["lol", "tbh", "gonna"]}
    data = []
    for i in range(400):
        target = float(i % 3 == 0)
        data.append((i, [rng.choice(words[target]) for _ in range(5)] + ["the", "a"], target))
    df = spark.createDataFrame(data, "text_id BIGINT, tokens ARRAY<STRING>, human_wrote DOUBLE")
    return split_by_hash(df, "text_id").persist()


def test_beats_the_majority_class_and_repeats(rows):
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    one = fit.evaluate(test, fit.fit(train, "tfidf_lr")).first()
    two = fit.evaluate(test, fit.fit(train, "tfidf_lr")).first()
    assert one == two and one["accuracy"] > 0.9


def test_scores_have_the_reported_columns(rows):
    model = fit.fit(rows.where("split = 'train'"), "tfidf_lr")
    got = fit.score(rows, model).select("prediction", "confidence", "label").distinct().collect()
    for x in got:
        assert x["label"] == ("Human-Written" if x["prediction"] == 1 else "AI-Generated") and 0.5 <= x["confidence"] <= 1


def test_hashed_once_says_what_the_whole_model_says(rows):
    model, counts = fit.fit_hashed(rows)
    whole = fit.evaluate(rows, fit.fit(rows.where("split = 'train'"), "tfidf_lr"), ["split"])
    assert sorted(fit.evaluate_hashed(counts, model, ["split"]).collect()) == sorted(whole.collect())
    assert fit.evaluate(rows, model).first() == fit.evaluate_hashed(counts, model).first() and counts.count() == rows.count()
    with pytest.raises(ValueError):
        fit.fit_hashed(rows, "w2v_lr")


def test_loss_falls(rows):
    losses = fit.loss_curve(fit.fit(rows.where("split = 'train'"), "tfidf_lr"))
    assert losses[-1] < losses[0]


def test_unknown_family(rows):
    with pytest.raises(ValueError):
        fit.classifier("transformer")


def test_selection_keeps_the_first_of_equals(rows):
    _, tried = fit.select_best(rows, [("tfidf_lr", {"step": 0.01}), ("tfidf_lr", {"step": 0.01})])
    assert tried[0][2] == tried[1][2]
    spark = rows.sparkSession
    kept = fit.kept_runs(spark.createDataFrame(tried, "family STRING, epoch INT, val_acc DOUBLE")).collect()
    assert [x["epoch"] for x in kept] == [0]


def test_word_vectors(rows):
    vectors = fit.train_word_vectors(rows, dims=4, min_count=1)
    assert vectors.columns == ["word", "vec"] and {len(r.vec) for r in vectors.collect()} == {4} and vectors.count() == 8


@pytest.mark.parametrize("family", ["tfidf_lr", "w2v_lr"])
def test_a_saved_model_scores_as_before(rows, family):
    model = fit.fit(rows.where("split = 'train'"), family)
    again = fit.load(fit.save(model, fresh_dir(rows.sparkSession, "models"), family))
    one, two = (sorted(map(str, fit.score(rows, m).select("text_id", "prediction", "confidence").collect())) for m in (model, again))
    assert one == two
