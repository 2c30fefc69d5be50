"""The corpus pipeline: quality classifier, near-dedup, substring dedup, benchmark decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows of ``docs`` and returns a DataFrame; all but the last return the columns of
``documents``. :func:`run` writes each result as Parquet in the shared folder and reads it back for the next stage.

* ``quality``: learns from ``labels`` and drops the documents whose score is below the threshold.
* ``near_dedup``: of documents connected by a five-word Jaccard similarity of 0.8 or more, the one with the smallest ``doc_id`` stays.
* ``substring_dedup``: words inside a 50-word window that a document with a smaller ``doc_id`` has are cut; documents of which nothing stays
  are dropped, other documents are unchanged. ``n_chars`` follows the text.
* ``decontamination``: documents that hold a benchmark item are dropped.
* ``packing``: pieces of documents with their sequence and offset.

Nulls, empty texts and repeated rows: as each operator says. Further columns are carried along until packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from penmark.llm import decontaminate, packing, quality, similar, window_dedup
from penmark.llm.common import store, table
from penmark.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = store(quality.features(docs), "pipeline-features")
    return quality.keep_good(docs, quality.fit(rows, table(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similar.keep_one(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = window_dedup.rewrite(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else cut


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path(), keep_ids=False)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: No stage can be stated in SQL (a fitted model, connected components, hashed windows); tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from all of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
