"""Cost roll-up and budget notifications."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def cost_rollup(costs: DataFrame, by: Sequence[str] = ("service",), cost: str = "cost") -> DataFrame:
    """Total cost per service, highest first."""
    return costs.groupBy(*by).agg(F.sum(F.col(cost).cast(MONEY)).alias("cost")).orderBy(F.col("cost").desc(), *by)


def budget_status(costs: DataFrame, amount: float = 30, usage_date: str = "usage_date", cost: str = "cost", as_of: str | None = None) -> DataFrame:
    """Spend per month against the budget: 50 and 100 percent of actual, 80 percent of forecast, all strict.

    The forecast extends the spend so far in a straight line over the month.
    The open month is measured up to ``as_of`` (by default the month's last
    usage date); months before it are complete.
    """
    day = F.col(usage_date).cast("date")
    lines = costs if as_of is None else costs.filter(day <= F.lit(as_of).cast("date"))
    months = lines.groupBy(F.trunc(day, "month").alias("month")).agg(
        F.sum(F.col(cost).cast(MONEY)).alias("actual"), F.max(day).alias("last_day")
    )
    days = F.dayofmonth(F.last_day("month"))
    if as_of is None:
        elapsed = F.dayofmonth("last_day")
    else:
        open_month = F.trunc(F.lit(as_of).cast("date"), "month") == F.col("month")
        elapsed = F.when(open_month, F.dayofmonth(F.lit(as_of).cast("date"))).otherwise(days)
    spent = F.col("actual").cast("double")
    forecast = spent * days / elapsed
    return months.select(
        "month",
        "actual",
        forecast.alias("forecast"),
        (spent > amount * 0.5).alias("over_50_actual"),
        (forecast > amount * 0.8).alias("over_80_forecast"),
        (spent > amount).alias("over_100_actual"),
    )
