"""From logits to a reported class."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Class names (prediction 0 = generated, 1 = human).
GENERATED_NAME = "AI-Generated"
HUMAN_NAME = "Human-Written"


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def softmax(logits: Column) -> Column:
    shifted = F.transform(logits, lambda z: F.exp(z - F.array_max(logits)))
    return F.transform(shifted, lambda e: e / _total(shifted))


def softmax_columns(z0: Column, z1: Column) -> tuple[Column, Column]:
    """Two-class softmax on plain columns: stays inside generated code."""
    top = F.greatest(z0, z1)
    e0, e1 = F.exp(z0 - top), F.exp(z1 - top)
    return e0 / (e0 + e1), e1 / (e0 + e1)


def argmax(values: Column) -> Column:
    """Position of the largest value; the first one on a tie."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def confidence(logits: Column) -> Column:
    return F.array_max(softmax(logits))


def class_name(prediction: Column) -> Column:
    return F.when(prediction == 0, GENERATED_NAME).otherwise(HUMAN_NAME)


def fixed(value: Column, digits: int) -> Column:
    """A number with a fixed count of decimals, rounded by its exact binary value (a
    printf-style format would round the shortest decimal form instead)."""
    return F.call_function("format_number", value, F.lit("0." + "0" * digits))


def percent(share: Column, digits: int = 1) -> Column:
    return F.concat(fixed(share * 100, digits), F.lit("%"))


def cross_entropy(logits: Column, target: Column) -> Column:
    """log-sum-exp of the logits minus the logit of the true class."""
    top = F.array_max(logits)
    log_sum = F.log(_total(F.transform(logits, lambda z: F.exp(z - top)))) + top
    return log_sum - F.element_at(logits, (target + 1).cast("int"))


def linear_logit(features: Column, weights: list[float], bias: float) -> Column:
    """One output of a linear layer over a feature array."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    products = F.zip_with(features, w, lambda x, y: x.cast("double") * y)
    return _total(products) + F.lit(float(bias))
