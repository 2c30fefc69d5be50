"""Quoted CSV whose fields run over several lines, read by many tasks a file.

Spark gives a multi-line CSV file to one task. Here the file is read as lines, which split anywhere, and records are put together:

1. Every split counts its quotes. Summed over the splits before, their parity says whether a split begins inside a quoted field.
2. A running sum of quotes inside the split does the same for every line. A record begins at each line that does not begin inside a field.
3. Lines of a record are joined inside their split. The lines at the head of a split that belong to the record before (at most one
   fragment a split, also where a record covers whole splits) are appended to it.

A quote may stand only around a field, doubled inside it: what every CSV writer gives. Lines are shuffled once, to the task of their split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

# A quote inside a quoted field is doubled, and a field may run over several lines.
CSV_QUOTING = {"quote": '"', "escape": '"', "multiLine": "true"}
SPLIT = ["src_file", "block"]


def _quotes(line: Column) -> Column:
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))


def _joined(pieces: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(pieces), lambda x: x["line"]), "\n")


def read_quoted(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """``record, src_file, src_row`` of every CSV record that is not empty. ``src_row`` grows along the file; the first record has 0."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"),
    ).withColumn("quotes", _quotes(F.col("line")))

    along = Window.partitionBy("src_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy(*SPLIT).agg(F.sum("quotes").alias("quotes"))
    splits = splits.select(*SPLIT, F.coalesce(F.sum("quotes").over(along), F.lit(0)).alias("earlier"))

    inside = Window.partitionBy(*SPLIT).orderBy("at")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.select(
        *SPLIT, "line", F.coalesce(F.sum("quotes").over(before), F.lit(0)).alias("own"),
        (F.col("block") + F.row_number().over(inside) - 1).alias("place"),
    )
    opened = placed.join(splits, SPLIT).withColumn("begins", (F.col("own") + F.col("earlier")) % 2 == 0)
    start = F.max(F.when(F.col("begins"), F.col("place"))).over(Window.partitionBy(*SPLIT).orderBy("place"))
    pieces = opened.withColumn("start", start).groupBy(*SPLIT, "start").agg(
        _joined(F.collect_list(F.struct("place", "line"))).alias("line")
    )
    # a fragment goes to the last record that began in an earlier split of its file, which is the last of its split:
    # records meet their fragment where they are, by split
    last = pieces.groupBy(*SPLIT).agg(F.max("start").alias("start"))
    began = F.when(F.col("start").isNotNull(), F.struct("start", F.col("block").alias("owner_block")))
    owner = last.select(*SPLIT, F.max(began).over(along).alias("owner"))
    fragments = pieces.where(F.col("start").isNull()).join(owner, SPLIT).where("owner IS NOT NULL").groupBy(
        "src_file", F.col("owner.owner_block").alias("block"), F.col("owner.start").alias("owner")
    ).agg(_joined(F.collect_list(F.struct(F.col("block").alias("place"), "line"))).alias("rest"))
    whole = pieces.where(F.col("start").isNotNull()).join(fragments, SPLIT, "left")
    whole = whole.withColumn("rest", F.when(F.col("start") == F.col("owner"), F.col("rest")))
    text = F.concat_ws("\n", "line", "rest")
    record = F.when(F.col("line").isNotNull(), text)
    if encoding != "UTF-8":
        record = F.decode(record.cast("binary"), encoding)
    records = whole.select(F.regexp_replace(record, "\r$", "").alias("record"), "src_file", F.col("start").alias("src_row"))
    return records.where((F.length("record") > 0) | (F.col("src_row") == 0))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = False, encoding: str = "UTF-8") -> DataFrame:
    """The fields of ``schema``, with ``src_file, src_row``. ``header``: the first record of each file is none."""
    if isinstance(schema, T.StructType):
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    records = read_quoted(spark, path, encoding)
    records = records.where(F.col("src_row") > 0) if header else records.where(F.length("record") > 0)
    return records.select(F.from_csv("record", schema, CSV_QUOTING).alias("row"), "src_file", "src_row").select("row.*", "src_file", "src_row")
