"""Turn landed records into curated tables and one labelled main table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from penmark.functions.ids import GENERATED_SOURCE, POST_SOURCE, canonical_id
from penmark.functions.text import strip_ws
from penmark.operators.dedup import keep_first
from penmark.operators.positions import chunk_of, chunk_or_any, dense_ids

HUMAN, GENERATED = 0, 1


def normalise_text(df: DataFrame) -> DataFrame:
    return df.withColumn("text", strip_ws(F.col("text")))


def drop_empty(df: DataFrame) -> DataFrame:
    """Null text goes as well: the comparison is then unknown."""
    return df.where(F.length("text") > 0)


def default_label(df: DataFrame, label: int) -> DataFrame:
    given = F.col("label") if "label" in df.columns else F.lit(None)
    return df.withColumn("label", F.coalesce(given.cast("int"), F.lit(label)))


def add_optional(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Columns (name -> type) that a source may lack, as typed nulls."""
    absent = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def original_id(df: DataFrame) -> Column:
    """The source's own id, or the ingest position where there is none."""
    known = [F.col(c).cast("string") for c in ("text_id", "pos") if c in df.columns]
    return F.coalesce(*known)


def assign_canonical_id(df: DataFrame, source: str) -> DataFrame:
    return df.withColumn("text_id", canonical_id(source, original_id(df)))


def _curate(df: DataFrame, source: str, label: int) -> DataFrame:
    ready = df.transform(normalise_text).transform(drop_empty).transform(default_label, label)
    # The id depends on its own row only, so it is hashed for the kept rows alone.
    return ready.transform(keep_first, ["text"], "pos").transform(assign_canonical_id, source)


def curate_posts(df: DataFrame) -> DataFrame:
    """Stripped, non-empty, labelled human by default, first copy of each text."""
    return _curate(df, POST_SOURCE, HUMAN)


def curate_generated(df: DataFrame) -> DataFrame:
    """As :func:`curate_posts`, labelled generated by default, with the optional columns."""
    curated = _curate(df, GENERATED_SOURCE, GENERATED)
    return curated.transform(add_optional, {"prompt_name": "string", "model": "string"}).withColumn(
        "source", F.lit(GENERATED_SOURCE)
    )


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows by stage and label."""
    counted = [
        df.groupBy("label").agg(F.count(F.lit(1)).alias("records")).withColumn("stage", F.lit(name))
        for name, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def placed(df: DataFrame) -> DataFrame:
    """``text`` and ``label`` with their place in the source.

    Rows read from text files are placed by file and row (``src_file``, ``src_row``). Other
    rows are placed by their unique ``pos``; rows without one come first.
    """
    if "src_file" in df.columns:
        return df.select("text", "label", "src_file", "src_row", chunk_of(F.col("src_row")).alias("src_chunk"))
    return df.select(
        "text", "label", F.lit("").alias("src_file"), F.col("pos").alias("src_row"),
        chunk_or_any(chunk_of(F.col("pos")), ["text", "label"]).alias("src_chunk"),
    )


def union_sources(sources: list[DataFrame]) -> DataFrame:
    """UNION ALL in the given order; ``src_ord`` remembers it. Nothing is de-duplicated."""
    numbered = [df.withColumn("src_ord", F.lit(i)) for i, df in enumerate(sources)]
    return reduce(DataFrame.unionByName, numbered)


def merge_main(sources: list[DataFrame]) -> DataFrame:
    """The main table: placed sources in order, with ``text_id`` 0..n-1."""
    merged = union_sources(sources)
    chunk = ["src_ord", "src_file", "src_chunk"]
    return dense_ids(merged, ["src_row"], chunk, "text_id").select("text", "label", "text_id")
