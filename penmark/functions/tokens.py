"""Token and index arrays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from penmark.functions.text import NOT_WS, WS

# The token filter, the length of a fixed-size sample, the padding index.
ALPHA_TOKEN = r"^[A-Za-z]+$"
FIXED_LENGTH = 128
PAD = 0


def tokenize(text: Column) -> Column:
    """Split at Unicode whitespace; no empty tokens."""
    return F.filter(F.split(text, rf"{WS}+"), lambda w: w != "")


def keep_alpha(tokens: Column) -> Column:
    """Keep the tokens made of ASCII letters only."""
    return F.filter(tokens, lambda w: w.rlike(ALPHA_TOKEN))


def alpha_tokens(text: Column) -> Column:
    """``keep_alpha(tokenize(text))`` in one search of the text: runs of ASCII letters with whitespace or an end on both sides."""
    return F.regexp_extract_all(text, F.lit(rf"(?<!{NOT_WS})[A-Za-z]++(?!{NOT_WS})"), F.lit(0))


def parse_list_literal(literal: Column) -> Column:
    """``['a', "it's"]`` written as text becomes an array of strings."""
    return F.from_json(
        literal,
        "array<string>",
        {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"},
    )


def list_literal(tokens: Column) -> Column:
    """The inverse of :func:`parse_list_literal` for tokens without quotes."""
    return F.concat(
        F.lit("["),
        F.array_join(F.transform(tokens, lambda w: F.concat(F.lit("'"), w, F.lit("'"))), ", "),
        F.lit("]"),
    )


def pad_right(ids: Column, length: Column) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(PAD), (length - F.size(ids)).cast("int")))


def fixed_ids(ids: Column, length: int = FIXED_LENGTH) -> Column:
    """Cut or pad an index array to exactly ``length``."""
    return pad_right(F.slice(ids, 1, length), F.lit(length))


def attention_mask(ids: Column, length: int = FIXED_LENGTH) -> Column:
    """1 for each real position, 0 for each padded one."""
    used = F.least(F.size(ids), F.lit(length))
    return F.concat(F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), F.lit(length) - used))
