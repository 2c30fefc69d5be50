"""First-occurrence de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def keep_first(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """One row per ``by`` value: the one with the smallest ``order``.

    An aggregation rather than a window, so copies collapse before the shuffle and a
    text that fills a third of the table costs one row per task. While the other columns
    have a fixed width the aggregate is hash based; a wider row travels as one struct.
    A null ``order`` comes last; among rows with equal order a hash of the row decides, so
    the kept values always come from one row.
    """
    rest = [f for f in df.schema.fields if f.name not in by and f.name != order]
    tie = F.xxhash64(*[f.name for f in rest]) if rest else F.lit(0).cast("bigint")
    if isinstance(df.schema[order].dataType, T.IntegralType) and all(isinstance(f.dataType, _FIXED_WIDTH) for f in rest):
        # One number for order and tie, so that the buffers have a fixed width too.
        last = F.coalesce(F.col(order).cast("decimal(20,0)"), F.lit((1 << 63) - 1).cast("decimal(20,0)"))
        place = (last * F.lit(1 << 32).cast("decimal(11,0)") + F.pmod(tie, F.lit(1 << 32)).cast("decimal(11,0)")).cast("decimal(38,0)")
        picked = [F.min_by(f.name, place).alias(f.name) for f in [df.schema[order], *rest]]
        kept = df.groupBy(*by).agg(*picked)
    else:
        place = F.struct(F.col(order).isNull(), F.col(order), tie)
        row = F.struct(order, *[f.name for f in rest])
        kept = df.groupBy(*by).agg(F.min_by(row, place).alias("_row")).select(*by, "_row.*")
    return kept.select(*df.columns)
