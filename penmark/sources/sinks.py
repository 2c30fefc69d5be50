"""Tables out. Every writer returns the path it wrote."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame

# The run stamp and the file types a cleaned table may have.
RUN_STAMP = "%Y%m%dT%H%M%SZ"
FILE_TYPES = ("parquet", "csv")

# Keep texts as they are: no trimming, doubled quotes, quoted empty strings.
CSV_WRITING = {
    "quote": '"', "escape": '"', "emptyValue": '""',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def run_stamp(at: datetime | None = None) -> str:
    return (at or datetime.now(timezone.utc)).strftime(RUN_STAMP)


def write_curated(df: DataFrame, root: str, kind: str, stamp: str | None = None) -> tuple[str, int]:
    """Write one run of a curated table; returns its path and row count.

    The count comes from the footers of the files written: no column is read, and it is
    what is really there. (An Observation would count on the way, but once a session has
    one, Spark 4.1 can no longer ship a fitted logistic regression to its tasks.)
    """
    path = f"{root}/curated/{kind}/run={stamp or run_stamp()}"
    df.write.parquet(path)
    return path, df.sparkSession.read.parquet(path).count()


def append_csv(df: DataFrame, path: str) -> str:
    """Append part files; each carries its own header line."""
    df.write.mode("append").options(header="true", **CSV_WRITING).csv(path)
    return path


def write_cleaned(df: DataFrame, path: str, file_type: str = "parquet") -> str:
    if file_type not in FILE_TYPES:
        raise ValueError(f"file_type must be one of {FILE_TYPES}")
    options = {"header": "true", **CSV_WRITING} if file_type == "csv" else {}
    df.write.format(file_type).options(**options).save(path)
    return path


def write_human_csv(df: DataFrame, path: str) -> str:
    """The headerless six-column Latin-1 form."""
    df.write.options(encoding="ISO-8859-1", **CSV_WRITING).csv(path)
    return path
