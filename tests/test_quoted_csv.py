"""Multi-line CSV read by many tasks: the rows that Spark's own reader gives in one."""

from __future__ import annotations

import csv
import random

import pytest

from penmark.sources.quoted import CSV_QUOTING, read_csv, read_quoted

FIELDS = "a string, b string, c string"


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def field(rng: random.Random) -> str:
    parts = ["word", "é", '"', ",", "\n", "\r\n", "\n\n", " ", '""', "x" * 40]
    return "".join(rng.choices(parts, k=rng.randint(0, 9)))


def write(path, rows, encoding="utf-8", end="\n"):
    with open(path, "w", encoding=encoding, newline="") as out:
        csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator=end).writerows(rows)


@pytest.mark.parametrize("encoding,end", [("utf-8", "\n"), ("utf-8", "\r\n"), ("iso-8859-1", "\n")])
def test_same_rows_as_the_whole_file_reader(spark, small_splits, tmp_path, encoding, end):
    rng = random.Random(encoding + end)
    want = []
    for k in range(3):
        rows = [[str(i), field(rng), field(rng)] for i in range(120)]
        rows[50][1] = "long\n" * 900  # covers whole splits
        write(tmp_path / f"part{k}.csv", rows, encoding, end)
        want += [tuple(x or None for x in row) for row in rows]
    code = "ISO-8859-1" if encoding != "utf-8" else "UTF-8"
    got = read_csv(spark, str(tmp_path), FIELDS, encoding=code)
    assert sorted(map(tuple, got.select("a", "b", "c").collect()), key=repr) == sorted(want, key=repr)
    if end == "\n":  # Spark guesses line ends from the first one, which may be in a field
        plain = lambda rows: sorted((tuple(x and x.replace("\r\n", "\n") for x in r) for r in rows), key=repr)
        whole = spark.read.schema(FIELDS).options(encoding=code, **CSV_QUOTING).csv(str(tmp_path))
        assert plain(whole.collect()) == plain(want)
    assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 10
    placed = [r for r in got.collect()]
    for name in {r.src_file for r in placed}:
        own = sorted((r.src_row, int(r.a)) for r in placed if r.src_file == name)
        assert [a for _, a in own] == list(range(120)) and len({p for p, _ in own}) == 120 and own[0][0] == 0


def test_header_blank_lines_and_open_end(spark, small_splits, tmp_path):
    (tmp_path / "x.csv").write_text('a,b,c\n1,"two\n\nlines",3\n\n4,,"5"\n6,"never closed\nto the end')
    got = [tuple(r)[:3] for r in read_csv(spark, str(tmp_path), FIELDS, header=True).orderBy("src_row").collect()]
    whole = spark.read.schema(FIELDS).options(header="true", **CSV_QUOTING).csv(str(tmp_path))
    assert got == [tuple(r) for r in whole.collect()] and len(got) == 3
    (tmp_path / "y").mkdir()
    (tmp_path / "y" / "empty.csv").write_text("")
    assert read_quoted(spark, str(tmp_path / "y")).count() == 0
