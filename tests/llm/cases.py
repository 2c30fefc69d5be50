"""Documents with everything that can be odd about a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_STORY = "The quick brown fox jumps over the lazy dog while nine wise owls watch from the old oak tree near the river bank"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, runs long, score string, stays int, `start` int"

_TEXTS: list[tuple[int | None, str | None]] = [
    (1, _STORY), (2, _STORY), (2, _STORY), (3, _STORY + " today"), (4, None), (5, ""), (6, " \t\n "), (None, _STORY), (None, None),
    (7, "word"), (8, "two words"), (9, "é à ü   x y"), (10, ("tail " * 3000).strip()), (11, _STORY.upper()), (12, "\0 a\0b"),
    (13, "Some other text that nobody else has written, not even once, in this small table of documents."), (-5, "word"),
]
DOCS = [(k, t, "en", None, len(t or ""), "x", 3, "y", 1, 0) for k, t in _TEXTS]


def documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DOCS, SCHEMA).repartition(3)
