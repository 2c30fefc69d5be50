"""Files in: corpora, curated tables, token tables, records, model files, requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from penmark import schemas
from penmark.functions import naming, tokens as tk
from penmark.operators.curate import HUMAN
from penmark.operators.positions import chunk_of, dense_ids
from penmark.sources.quoted import CSV_QUOTING, read_csv

# Fixed value: the encoding of the human corpus.
LATIN1 = "ISO-8859-1"


def with_file_place(df: DataFrame) -> DataFrame:
    """Add where a row was read: its file, and a number that grows along the file."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("src_file"),
        F.monotonically_increasing_id().alias("src_row"),
    )


def read_human_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless six-column Latin-1 CSV; every row is human."""
    rows = read_csv(spark, path, schemas.HUMAN_CSV, encoding=LATIN1)
    return rows.select("text", F.lit(HUMAN).alias("label"), "src_file", "src_row")


def read_labelled_csv(
    spark: SparkSession, path: str, na_tokens: tuple[str, ...] = ()
) -> DataFrame:
    """CSV with a header, of which ``text`` and ``label`` are kept, found by name. Fails if one is absent.

    ``na_tokens`` are texts to read as missing (``NA``, ``null``, ...).
    """
    names = spark.read.options(header="true", **CSV_QUOTING).csv(path).columns
    fields = T.StructType([T.StructField(name, T.StringType()) for name in names])
    kept = read_csv(spark, path, fields, header=True).select("text", F.col("label").cast("int").alias("label"), "src_file", "src_row")
    if na_tokens:
        kept = kept.withColumn("text", F.when(~F.col("text").isin(*na_tokens), F.col("text")))
    return kept


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    """``text``, ``label`` and the ingest position of a curated table."""
    return spark.read.parquet(path).select("text", "label", "pos")


def read_token_csv(spark: SparkSession, path: str) -> DataFrame:
    """Token table as CSV: an unnamed index column, ``text`` (list literal), ``human_wrote``."""
    schema = "_c0 BIGINT, text STRING, human_wrote INT"
    rows = read_csv(spark, path, schema, header=True)
    return rows.select("text", "human_wrote").withColumn("tokens", tk.parse_list_literal(F.col("text")))


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON records with ragged keys; an absent key is null."""
    return spark.read.schema(schema).json(path)


def read_placed_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records that carry no position, with one: ``pos`` 0.. by file name, then by row.

    Store the result: the position belongs to this reading of the files.
    """
    fields = T.StructType([f for f in schema.fields if f.name != "pos"])
    placed = with_file_place(spark.read.schema(fields).json(path)).withColumn("_chunk", chunk_of(F.col("src_row")))
    numbered = dense_ids(placed, ["src_row"], ["src_file", "_chunk"], "pos")
    return numbered.select(*fields.names, "pos")


def scan_model_files(spark: SparkSession, path: str, glob: str = naming.MODEL_GLOB) -> DataFrame:
    """Path, size and time of each model file; the contents are never read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
