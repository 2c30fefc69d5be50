"""Rows that carry texts move once."""

from __future__ import annotations

from pyspark.sql import functions as F

from penmark.operators.positions import dense_ids
from penmark.sources.quoted import read_quoted


def joins(df) -> list[str]:
    text = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in text.splitlines() if "Join " in line]


def test_numbered_rows_meet_no_join(spark):
    rows = spark.range(50).select("id", F.lit("text").alias("text"), (F.col("id") % 7 - 1).alias("c"))
    rows = rows.withColumn("c", F.when(F.col("c") >= 0, F.col("c")))
    found = dense_ids(rows, ["id"], ["c"], "place")
    assert len(joins(found)) == 1  # sizes of chunks with sizes of their groups
    order = sorted(rows.collect(), key=lambda r: (r.c is not None, r.c or 0, r.id))
    assert [(r.id, r.text) for r in sorted(found.collect(), key=lambda r: r.place)] == [(r.id, r.text) for r in order]
    assert sorted(r.place for r in found.collect()) == list(range(50))


def test_records_meet_their_fragments_by_split(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"a\nb",1\n"c",2\n')
    found = read_quoted(spark, str(tmp_path))
    assert [r.record for r in found.orderBy("src_row").collect()] == ['"a\nb",1', '"c",2']
    assert joins(found) and not any("start#" in line for line in joins(found))
