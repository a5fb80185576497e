"""Date expressions: day bounds and storage tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def capture_interval(day: Column) -> dict[str, Column]:
    """Half-open one-day interval ``[day, day + 1)`` for a ``YYYY-MM-DD`` day."""
    start = F.to_timestamp_ntz(day, F.lit("yyyy-MM-dd"))
    return {"captured_from": start, "captured_to": start + F.expr("INTERVAL 1 DAY")}


def day_filter(df: DataFrame, ts: str, day: str) -> DataFrame:
    """Rows of one logical day, written as a range so the bounds reach the file scan."""
    kind = df.schema[ts].dataType.typeName()
    literal = F.lit(day).cast(kind)
    return df.filter((F.col(ts) >= literal) & (F.col(ts) < literal + F.expr("INTERVAL 1 DAY")))


def lifecycle_tier(
    path: Column, modified: Column, as_of: str, prefix: str = "raw/", cool_after: int = 30, delete_after: int = 90
) -> Column:
    """``hot``, ``cool`` or ``delete`` for objects below ``prefix``; others are ``untouched``."""
    age = F.datediff(F.lit(as_of).cast("date"), modified.cast("date"))
    tier = F.when(age > delete_after, "delete").when(age > cool_after, "cool").otherwise("hot")
    return F.when(path.startswith(prefix), tier).otherwise(F.lit("untouched"))
