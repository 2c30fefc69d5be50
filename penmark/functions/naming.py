"""Model file names: building, parsing, sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The name pattern {type}_{accuracy}_{date}_{time}.pt, its time formats,
# what an unreadable name reports, and the known network types.
MODEL_NAME = r"^([a-zA-Z]+)_(\d+\.?\d*)_(\d{4}-\d{2}-\d{2})_(\d{2}-\d{2}-\d{2})\.pt$"
NAME_TIME = "yyyy-MM-dd_HH-mm-ss"
SHOWN_TIME = "yyyy-MM-dd HH:mm:ss"
UNKNOWN_TYPE = "UNKNOWN"
UNKNOWN_TIME = "Unknown"
MODEL_GLOB = "*.{pth,pt,pkl,model}"
NETWORK_TYPES = ("lstm", "rnn", "bert")
DEFAULT_TYPE = "rnn"
MEGABYTE = 1024 * 1024


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def size_mb(size: Column) -> Column:
    return F.bround(size / F.lit(float(MEGABYTE)), 2)


def parse_model_name(df: DataFrame, name: str = "name") -> DataFrame:
    """Add what a model file name says: type, accuracy, time, and whether it could be read.

    A name of the right shape with an impossible date still counts as parsed: only its
    timestamp is null. The pattern runs once per name; the parts of a name that fits it
    are between its underscores.
    """
    parts = F.when(F.col(name).rlike(MODEL_NAME), F.split(F.col(name), "_"))
    read = df.withColumn("_part", parts)
    part = lambda i: F.element_at("_part", i)
    clock = F.regexp_replace(part(4), r"\.pt$", "")
    timed = read.withColumn("_clock", clock).withColumn(
        "timestamp",
        F.try_to_timestamp(F.concat_ws("_", part(3), "_clock"), F.lit(NAME_TIME)).cast("timestamp_ntz"),
    )
    parsed = F.col("_part").isNotNull()
    shown = F.coalesce(
        F.date_format("timestamp", SHOWN_TIME), F.concat(part(3), F.lit(" "), F.col("_clock"))
    )
    return timed.withColumns(
        {
            "model_type": F.coalesce(F.upper(part(1)), F.lit(UNKNOWN_TYPE)),
            "accuracy": F.coalesce(part(2).cast("double"), F.lit(0.0)),
            "formatted_time": F.coalesce(shown, F.lit(UNKNOWN_TIME)),
            "parsed": parsed,
        }
    ).drop("_part", "_clock")


def checkpoint_name(kind: Column, accuracy: Column, saved_at: Column) -> Column:
    """File name of a saved state: type, accuracy in percent with one decimal, time."""
    shown = F.bround(accuracy * 100, 1).cast("string")
    stem = F.concat_ws("_", kind, shown, F.date_format(saved_at, NAME_TIME))
    return F.concat(stem, F.lit(".pt"))


def resolve_type(model_type: Column, parsed: Column, given: Column) -> Column:
    """The network type to load: as given, else from the name, else the default."""
    from_name = F.when(parsed, F.lower(model_type))
    wanted = F.lower(F.coalesce(given, from_name, F.lit(DEFAULT_TYPE)))
    return F.when(wanted.isin(*NETWORK_TYPES), wanted).otherwise(DEFAULT_TYPE)
