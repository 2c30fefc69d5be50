"""Run a registered query and its SQL check and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, bool) or value is None:
        return value
    return str(value) if not isinstance(value, int) else value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(db, df, sql: str) -> list[str]:
    """Empty when both give the same columns and the same rows."""
    found = db.execute(sql)
    sql_columns = [d[0] for d in found.description]
    if sorted(sql_columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(sql_columns)}"]
    want = _rows(sql_columns, found.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(want) != len(got):
        return [f"{len(got)} rows, SQL has {len(want)}"]
    if not want:
        return ["no rows on either side"]
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return [f"{len(bad)} of {len(want)} rows differ, first: {str(bad[0])[:600]}"] if bad else []
