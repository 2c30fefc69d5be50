"""Families compared on stored features."""

from __future__ import annotations

import random


from penmark.operators import fit, word_vectors as wv
from penmark.operators.split import split_by_hash


def test_families_compared_say_what_each_model_says(spark, monkeypatch):
    rng = random.Random(9)
    words = {0.0: ["moreover", "thus", "notably"], 1.0: ["lol", "tbh", "gonna"]}
    data = [(i, [rng.choice(words[float(rng.random() < 0.9 and i % 3 == 0)]) for _ in range(4)], float(i % 3 == 0)) for i in range(300)]
    data += [(7, data[7][1], data[7][2]), (1000, [], 0.0)]
    df = split_by_hash(spark.createDataFrame(data, "text_id BIGINT, tokens ARRAY<STRING>, human_wrote DOUBLE"), "text_id").persist()
    train, val = df.where("split = 'train'"), df.where("split = 'val'")
    want = {family: fit.evaluate(val, model).first() for family, model in fit.fit_each(train, sorted(fit.FAMILIES))}
    calls = []
    for name in ("train_vectors", "mean_features"):
        whole = getattr(wv, name)
        monkeypatch.setattr(wv, name, lambda *a, whole=whole, name=name, **k: calls.append(name) or whole(*a, **k))
    got = {family: accuracy.first() for family, accuracy in fit.compare_families(df, sorted(fit.FAMILIES))}
    assert got == want and calls == ["train_vectors", "mean_features"]


def test_families_read_stored_tokens(spark, sf_dir, monkeypatch):
    """Tokens are stored once, in place of a cache that keeps them as objects, and read by every family."""
    from penmark.plans import QUERIES

    seen, whole = [], fit.compare_families
    monkeypatch.setattr(fit, "compare_families", lambda df, *a, **k: seen.append(df) or whole(df, ["tfidf_lr"]))
    assert [r.family for r in QUERIES["model_families"](spark, sf_dir).collect()] == ["tfidf_lr"]
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan and "InMemoryRelation" not in plan
