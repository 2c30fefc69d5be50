"""Requests in, scored rows out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from penmark.functions import scoring as sc
from penmark.functions.rows import one_per_item
from penmark.functions.text import is_blank, strip_ws
from penmark.operators.lookup import lookup, measured_bytes
from penmark.session import materialise

# The error messages of the two request forms.
NO_TEXT = "No text provided"
EMPTY_TEXT = "Empty text provided"
NO_TEXTS = "No texts provided"
BAD_TEXTS = "Invalid texts format"
FAILED = "Prediction failed"
BATCH_FAILED = "Batch prediction failed"


def _request(body: Column, field: str) -> tuple[Column, Column, Column]:
    """Is the body JSON, does it have the field, and the type of its value."""
    parsed = F.try_parse_json(body)
    has = F.coalesce(F.array_contains(F.json_object_keys(body), field), F.lit(False))
    kind = F.schema_of_variant(F.try_variant_get(parsed, f"$.{field}", "variant"))
    return parsed.isNotNull(), has, F.coalesce(kind, F.lit("VOID"))


def single_text(body: Column) -> Column:
    """The stripped text of a ``{"text": ...}`` body."""
    return strip_ws(F.get_json_object(body, "$.text"))


def single_error(body: Column) -> Column:
    """Why a single request is refused, null when it is fine."""
    is_json, has, kind = _request(body, "text")
    return (
        F.when(~is_json, FAILED)
        .when(~has, NO_TEXT)
        .when(kind != "STRING", FAILED)
        .when(single_text(body) == "", EMPTY_TEXT)
    )


def batch_texts(body: Column) -> Column:
    """The texts of a ``{"texts": [...]}`` body."""
    return F.from_json(body, "texts array<string>")["texts"]


def batch_error(body: Column) -> Column:
    is_json, has, kind = _request(body, "texts")
    return (
        F.when(~is_json, BATCH_FAILED)
        .when(~has, NO_TEXTS)
        .when(~kind.startswith("ARRAY") | (F.size(batch_texts(body)) == 0), BAD_TEXTS)
    )


def explode_batch(df: DataFrame, body: str, keys: list[str]) -> DataFrame:
    """One row per text of each accepted batch, numbered in input order.

    A blank text is refused on its own row (``error``); its neighbours go on.
    """
    good = df.where(batch_error(F.col(body)).isNull())
    rows = one_per_item(good, keys, batch_texts(F.col(body)), "text", "index")
    blank = F.coalesce(is_blank(F.col("text")), F.lit(True))
    return rows.withColumn("error", F.when(blank, EMPTY_TEXT))


def split_block(df: DataFrame, block: str, keys: list[str]) -> DataFrame:
    """One row per non-blank line of a text block; a kept line is not trimmed."""
    lines = F.filter(F.split(strip_ws(F.col(block)), "\n"), lambda x: ~is_blank(x))
    return one_per_item(df, keys, lines, "text", "index")


def decide(df: DataFrame, z0: str = "z0", z1: str = "z1") -> DataFrame:
    """Prediction, confidence and class name from two logit columns."""
    p0, p1 = sc.softmax_columns(F.col(z0), F.col(z1))
    prediction = F.when(F.col(z1) > F.col(z0), 1).otherwise(0)
    return df.withColumns(
        {
            "prediction": prediction,
            "confidence": F.greatest(p0, p1),
            "label": sc.class_name(prediction),
        }
    )


def linear_scores(df: DataFrame, features: str, weights: list[list[float]], biases: list[float]) -> DataFrame:
    """A fixed two-class linear layer over a feature array, then :func:`decide`."""
    logits = {
        f"z{k}": sc.linear_logit(F.col(features), weights[k], biases[k]) for k in range(2)
    }
    return decide(df.withColumns(logits))


@dataclass(frozen=True)
class WordLogits:
    """What each word adds to the logits of a text, stored and measured once; every scoring, batch or micro-batch, reuses it."""

    table: DataFrame  # word, n, s0, s1
    bytes: int
    biases: tuple[float, float]


def word_logits(vocab: DataFrame, vectors: DataFrame, weights: list[list[float]], biases: list[float]) -> WordLogits:
    """Of a linear layer over mean word vectors. ``vocab`` has ``word, n, idx``, ``vectors`` the ``vec`` of each ``idx``; words without one add
    nothing. Written to the shared folder: call it before a stream starts."""
    joined = vocab.join(vectors, "idx", "left")
    parts = {f"s{k}": F.coalesce(sc.linear_logit(F.col("vec"), weights[k], 0.0), F.lit(0.0)) for k in range(2)}
    stored = materialise(joined.withColumns(parts).select("word", "n", "s0", "s1"))
    return WordLogits(stored, measured_bytes(stored), tuple(biases))


def score_words(df: DataFrame, logits: WordLogits, keys: list[str], tokens: str = "tokens") -> DataFrame:
    """Prediction, confidence and class name of each text: its logits are the mean of its words' parts, the biases for a text without words."""
    rows = df.select(*keys, F.posexplode_outer(tokens).alias("at", "word"))
    found = lookup(rows, logits.table, "word", spread_by=[keys[0], "at"], weight="n", table_bytes=logits.bytes)
    means = {f"z{k}": F.sum(F.coalesce(f"s{k}", F.lit(0.0))) / F.count(F.lit(1)) + F.lit(logits.biases[k]) for k in range(2)}
    return decide(found.groupBy(*keys).agg(*[z.alias(name) for name, z in means.items()]))


def accuracy(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Correct, total and their ratio; a missing prediction is wrong, no rows give a null ratio."""
    hit = F.coalesce((F.col("prediction") == F.col("target")).cast("int"), F.lit(0))
    return df.groupBy(*(by or [])).agg(
        F.coalesce(F.sum(hit), F.lit(0)).alias("correct"),
        F.count(F.lit(1)).alias("total"),
        F.avg(hit).alias("accuracy"),
    )


def as_json(df: DataFrame, fields: list[str], keys: list[str] | None = None) -> DataFrame:
    """Each row as one JSON document of the given fields."""
    return df.select(*(keys or []), F.to_json(F.struct(*fields)).alias("json"))
