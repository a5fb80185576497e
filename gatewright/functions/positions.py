"""Positions of rows in a total order, counted over all tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatewright.session import shared_dir


def with_position(rows: DataFrame, order: Sequence[str], column: str = "pos") -> DataFrame:
    """Add the place of each row, from 0, in ascending ``order``; equal rows in any order.

    Rows are sorted over all tasks and written once. A task's first place is the
    number of rows in the tasks before it, so only one number per task is ever
    brought together.
    """
    path, number = shared_dir(rows.sparkSession, "positions"), "__number"
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(number, F.monotonically_increasing_id())
    ordered.write.parquet(path)
    stored = rows.sparkSession.read.schema(ordered.schema).parquet(path)
    # The upper bits of the number are the task, the lower ones the row's place in it.
    task = F.shiftright(number, 33)
    sizes = stored.groupBy(task.alias("__task")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__task", F.coalesce(before, F.lit(0)).alias("__start"))
    place = F.col("__start") + F.col(number).bitwiseAND(F.lit((1 << 33) - 1))
    return stored.join(F.broadcast(starts), task == F.col("__task")).withColumn(column, place).drop("__task", "__start", number)
