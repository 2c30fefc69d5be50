"""Registered queries: each runs an operator over the given tables, most with a SQL check."""

from penmark.plans import (  # noqa: F401
    cleaning, corpus, encoding, landing, models, scoring, serving, training,
)
from penmark.plans.registry import CHECKS, QUERIES

__all__ = ["QUERIES", "CHECKS"]
