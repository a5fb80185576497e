"""Ordered scans (previous value, running last, running sum) that stay parallel inside one group.

A plain ``Window.partitionBy(key)`` puts a whole group into one task, which
fails when one key holds a third of the data. Here each group is cut into
chunks along its order. Every chunk is reduced to its closing state with
map-side combine, the closing states (one small row per chunk) are scanned per
group to get each chunk's opening state, and that state enters the chunk as one
extra leading row. The result equals the plain window for any chunk width.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

CHUNK, LEAD = "__chunk", "__lead"
# A key's rows at one instant that one task may well scan, and into how many parts more are cut.
BURST_ROWS, BURST_PARTS = 100_000, 32


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch; timestamps without zone are read as UTC session time."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(col.cast("timestamp"))


def time_chunk(ts: Column | str, seconds: int) -> Column:
    """Index of the fixed-width time chunk that holds ``ts``."""
    return F.floor(micros(ts) / F.lit(seconds * 1_000_000)).cast("bigint")


def with_order_chunk(
    df: DataFrame, keys: Sequence[str], ts: str, seq: str, seconds: int, burst_rows: int = BURST_ROWS, parts: int = BURST_PARTS
) -> DataFrame:
    """Add the chunk (``__chunk``) of every row along ``(ts, seq)``: a slice of time, and where that is not enough, a part of an instant.

    Rows of a key at one instant would share a slice of any width. Instants with
    more than ``burst_rows`` rows of a key are cut into ``parts`` by approximate
    quantiles of ``seq``. They are looked for only in slices that have so many
    rows, and a slice lists at most its rows divided by ``burst_rows`` of them.
    """
    slices = df.withColumn("__slice", time_chunk(ts, seconds))
    full = slices.groupBy(*keys, "__slice").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > burst_rows).drop("__n")
    crowded = _join_null_safe(slices.select(*keys, "__slice", ts, seq), full, [*keys, "__slice"], "left_semi")
    instants = crowded.groupBy(*keys, "__slice", ts).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > burst_rows).drop("__n")
    burst = _join_null_safe(crowded, instants, [*keys, "__slice", ts], "left_semi")
    shares = [k / parts for k in range(1, parts)]
    cuts = burst.groupBy(*keys, "__slice", ts).agg(F.percentile_approx(seq, shares, 1_000).alias("cuts"))
    listed = cuts.groupBy(*keys, "__slice").agg(F.collect_list(F.struct(F.col(ts).alias("at"), "cuts")).alias("__bursts"))
    placed = _join_null_safe(slices, listed, [*keys, "__slice"], "left")
    before = F.array_max(F.filter("__bursts", lambda b: b["at"] <= F.col(ts)))
    part = F.when(before["at"] == F.col(ts), F.size(F.filter(before["cuts"], lambda c: c < F.col(seq)))).when(before.isNotNull(), parts).otherwise(0)
    chunk = F.struct(F.col("__slice").alias("slice"), micros(before["at"]).alias("after"), part.alias("part"))
    return placed.withColumn(CHUNK, chunk).drop("__slice", "__bursts")


def _join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join on columns whose nulls equal each other, keeping the left side's names."""
    named = right.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns])
    same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(F.col(f"__r_{c}")) for c in on])
    return left.join(named, same, how).drop(*[f"__r_{c}" for c in on])


def _order_value(order: Sequence[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def in_chunk(keys: Sequence[str], order: Sequence[str], lead: bool = True) -> WindowSpec:
    """Rows of one chunk in order, the leading row first."""
    return Window.partitionBy(*keys, CHUNK).orderBy(*([LEAD] if lead else []), *order)


def by_chunk(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Spread rows by key and chunk.

    Said explicitly: input that is already partitioned by the key alone would
    satisfy a window over (key, chunk), and a hot key would stay in one task.
    """
    return rows.repartition(*keys, CHUNK)


def rows_before(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def rows_upto(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def with_opening(
    rows: DataFrame,
    keys: Sequence[str],
    closing: DataFrame,
    opening: Callable[[DataFrame, WindowSpec], DataFrame],
) -> DataFrame:
    """Put one leading row (``__lead`` = 0) with the opening state in front of every chunk.

    ``closing`` has one row per (keys, chunk). ``opening`` adds or replaces its
    columns by the state at the chunk's start, given the window that lists a
    group's chunks in order; columns named like those of ``rows`` enter the scan.
    """
    leads = opening(closing, Window.partitionBy(*keys).orderBy(CHUNK)).withColumn(LEAD, F.lit(0))
    wanted = [c for c in leads.columns if c in (*rows.columns, LEAD)]
    return by_chunk(rows.withColumn(LEAD, F.lit(1)).unionByName(leads.select(wanted), allowMissingColumns=True), keys)


def without_leads(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(LEAD) == 1).drop(CHUNK, LEAD)


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    *,
    last_before: Mapping[str, Column] | None = None,
    last_upto: Mapping[str, Column] | None = None,
    sum_upto: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add running columns per group, in ascending ``order``.

    ``last_before`` / ``last_upto`` give the last non-null value of an
    expression over the earlier rows, without / with the current one.
    ``sum_upto`` gives the inclusive running sum. ``chunk`` must not decrease
    along ``order`` within a group.
    """
    last_before, last_upto, sum_upto = dict(last_before or {}), dict(last_upto or {}), dict(sum_upto or {})
    names = [*last_before, *last_upto, *sum_upto]
    src = {n: f"__in_{n}" for n in names}
    lasts, sums = [*last_before, *last_upto], list(sum_upto)

    rows = df.withColumns(
        {CHUNK: chunk, **{src[n]: e for n, e in {**last_before, **last_upto, **sum_upto}.items()}}
    )
    position = _order_value(order)
    closing = rows.groupBy(*keys, CHUNK).agg(
        *[F.max_by(src[n], F.when(F.col(src[n]).isNotNull(), position)).alias(src[n]) for n in lasts],
        *[F.sum(src[n]).alias(src[n]) for n in sums],
    )

    def opening(ends: DataFrame, along: WindowSpec) -> DataFrame:
        earlier = rows_before(along)
        return ends.withColumns(
            {
                **{src[n]: F.last(src[n], ignorenulls=True).over(earlier) for n in lasts},
                **{src[n]: F.sum(src[n]).over(earlier) for n in sums},
            }
        )

    window = in_chunk(keys, order)
    scanned = with_opening(rows, keys, closing, opening).withColumns(
        {
            **{n: F.last(src[n], ignorenulls=True).over(rows_before(window)) for n in last_before},
            **{n: F.last(src[n], ignorenulls=True).over(rows_upto(window)) for n in last_upto},
            **{n: F.coalesce(F.sum(src[n]).over(rows_upto(window)), F.lit(0)) for n in sums},
        }
    )
    return without_leads(scanned).drop(*src.values())
