"""Request roll-ups, counters, rates and histograms over metric samples.

A counter table has label columns (the series key), ``ts`` and ``value``, one
row per series and time. Rates follow the usual monitoring rules: only samples
inside ``(t - window, t]`` count, a falling value is a restart, the increase is
extrapolated towards the window's edges, and fewer than two samples give no
result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatewright.functions.chunks import CHUNK, by_chunk, micros, ordered_scan, time_chunk
from gatewright.functions.labels import full_match

SECOND = 1_000_000
# Relative slack on the rank, so a sum of rates that should meet it exactly is not lost to rounding.
RANK_SLACK = 1e-12
HOUR, DAY = 3_600, 86_400


# ---------------------------------------------------------------- requests --


def request_rollup(requests: DataFrame, by: Sequence[str] = ("method", "route", "code"), seconds: str = "seconds") -> DataFrame:
    """Request count and total duration per series."""
    return requests.groupBy(*by).agg(F.count(F.lit(1)).alias("requests"), F.sum(seconds).alias("seconds_sum"))


def exposition_order(rollup: DataFrame) -> DataFrame:
    """Series numbered by route, method, code.

    Rows are ranked inside a route; routes (a bounded label) are offset by the
    rows of the routes before them. No task sees all series.
    """
    sizes = rollup.groupBy("route").agg(F.count(F.lit(1)).alias("series"))
    offsets = sizes.select(
        "route",
        F.coalesce(
            F.sum("series").over(Window.orderBy("route").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("before"),
    )
    rank = F.row_number().over(Window.partitionBy("route").orderBy("method", "code"))
    return (
        rollup.withColumn("__rank", rank)
        .join(offsets, "route")
        .withColumn("pos", (F.col("before") + F.col("__rank")).cast("bigint"))
        .drop("__rank", "before")
        .orderBy("route", "method", "code")
    )


def metric_families(rollup: DataFrame, version: str, prefix: str = "dataset_api") -> DataFrame:
    """Build info, request counter and duration counter as one long table (metric, labels, value)."""
    labels = F.create_map(
        F.lit("method"), F.col("method"), F.lit("route"), F.col("route"), F.lit("code"), F.col("code").cast("string")
    )

    def family(name: str, value: str) -> DataFrame:
        return rollup.select(F.lit(f"{prefix}_{name}").alias("metric"), labels.alias("labels"), F.col(value).cast("double").alias("value"))

    info = rollup.sparkSession.range(1).select(
        F.lit(f"{prefix}_build_info").alias("metric"),
        F.create_map(F.lit("version"), F.lit(version)).alias("labels"),
        F.lit(1.0).alias("value"),
    )
    return (
        info.unionByName(family("http_requests_total", "requests"))
        .unionByName(family("http_request_duration_seconds_sum", "seconds_sum"))
    )


def event_counter(events: DataFrame, keys: Sequence[str], ts: Column, amount: Column | None = None, chunk_seconds: int = DAY) -> DataFrame:
    """Turn events into counter samples: the running total per series at every time it changes."""
    amount = F.lit(1).cast("bigint") if amount is None else amount
    steps = events.withColumns({"ts": ts, "__amount": amount}).groupBy(*keys, "ts").agg(F.sum("__amount").alias("__amount"))
    running = ordered_scan(steps, keys, ["ts"], time_chunk("ts", chunk_seconds), sum_upto={"value": F.col("__amount")})
    return running.withColumn("value", F.col("value").cast("double")).drop("__amount")


def daily_counter(steps: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    """Counter samples from amounts per time step, restarting every day.

    A group is one series on one day, so it holds at most a day's steps and a
    plain window does.
    """
    day = Window.partitionBy(*keys, F.date_trunc("day", "ts")).orderBy("ts")
    total = F.sum(amount).over(day.rowsBetween(Window.unboundedPreceding, 0))
    return steps.select(*keys, "ts", total.cast("double").alias("value"))


def quality_failures_total(folded: DataFrame, keys: Sequence[str] = ("dataset",)) -> DataFrame:
    """Running count of recorded ``failed`` verdicts, from a folded action log."""
    failed = folded.filter((F.col("action") == "quality") & (F.col("outcome") == "ok") & (F.col("status") == "failed"))
    return event_counter(failed, keys, F.col("ts"))


def freeze_rejected_total(folded: DataFrame, keys: Sequence[str] = ("dataset",)) -> DataFrame:
    """Running count of freezes the gate refused, from a folded action log."""
    refused = folded.filter((F.col("action") == "freeze") & (F.col("outcome") == "quality_not_passed"))
    return event_counter(refused, keys, F.col("ts"))


# ---------------------------------------------------------------- counters --


def counter_deltas(samples: DataFrame, keys: Sequence[str], chunk_seconds: int = DAY) -> DataFrame:
    """Increment per sample; after a restart (falling value) the new value itself. The first sample has none."""
    scanned = ordered_scan(
        samples, keys, ["ts"], time_chunk("ts", chunk_seconds), last_before={"__prev": F.col("value")}
    )
    return scanned.withColumn("delta", _step(F.col("value"), F.col("__prev"))).drop("__prev")


def _step(value: Column, prev: Column) -> Column:
    return F.when(value < prev, value).otherwise(value - prev)


def extrapolated(raw: Column, n: Column, first_ts: Column, last_ts: Column, first_value: Column, start: Column, end: Column) -> Column:
    """Scale an in-window increase to the whole window (times in microseconds, window ``(start, end]``)."""
    sampled = (last_ts - first_ts).cast("double")
    spacing = sampled / (n - 1)

    def reach(gap: Column) -> Column:
        return F.when(gap >= spacing * 1.1, spacing / 2).otherwise(gap)

    head = reach((first_ts - start).cast("double"))
    # A counter cannot have been below zero before its first sample.
    zero = F.when((raw > 0) & (first_value >= 0), sampled * first_value / raw)
    head = F.least(head, zero)
    tail = reach((end - last_ts).cast("double"))
    return raw * (sampled + head + tail) / sampled


def counter_increase(
    samples: DataFrame,
    keys: Sequence[str],
    window_seconds: int,
    step_seconds: int | None = None,
    extrapolate: bool = True,
    chunk_seconds: int | None = None,
) -> DataFrame:
    """Increase over ``(t - window, t]`` per series.

    ``t`` runs over the series' own sample times, or with ``step_seconds`` over
    a regular grid, which makes results of different series line up.

    Series are cut into time chunks and every sample is also given to the later
    chunks whose windows can still see it, so one series spreads over many tasks
    at one shuffle. ``chunk_seconds`` may be shorter than the window: a hot series
    then fills more tasks, and a sample is copied ``window / chunk`` times. Inside a chunk each sample contributes the times it answers
    and the time it becomes the oldest sample in the window, which is when the
    sample before it leaves. The latest such time at or before ``t`` names the
    first sample of the window, so the cost per sample does not grow with it.
    """
    window = window_seconds * SECOND
    width = (chunk_seconds or max(HOUR, 4 * window_seconds)) * SECOND

    t = F.col("__t")
    home = F.floor(t / F.lit(width)).cast("bigint")
    seen_until = F.floor((t + F.lit(window - 1)) / F.lit(width)).cast("bigint")
    rows = samples.select(*keys, micros("ts").alias("__t"), F.col("value").cast("double").alias("__v")).filter(
        F.col("__v").isNotNull()
    )
    rows = by_chunk(rows.withColumn(CHUNK, F.explode(F.sequence(home, seen_until))), keys)

    part = Window.partitionBy(*keys, CHUNK)
    by_time = part.orderBy("__t")
    rows = rows.withColumns(
        {
            "__prev": F.lag("__t").over(by_time),
            "__next": F.lead("__t").over(by_time),
            "__d": F.coalesce(_step(F.col("__v"), F.lag("__v").over(by_time)), F.lit(0.0)),
        }
    )
    rows = rows.withColumns(
        {
            "__s": F.sum("__d").over(by_time.rowsBetween(Window.unboundedPreceding, 0)),
            "__i": F.row_number().over(by_time),
        }
    )
    # A sample without a neighbour inside the window never meets a second one.
    near = (t - F.col("__prev") < window) | (F.col("__next") - t < window)
    rows = rows.filter(F.coalesce(near, F.lit(False)))

    # Times answered by this sample: from its own time up to the next sample, while it
    # is still in the window, and only inside the chunk.
    begin, end = F.col(CHUNK) * F.lit(width), (F.col(CHUNK) + 1) * F.lit(width)
    if step_seconds is None:
        answers = F.when(t >= begin, F.array(t))
    else:
        step = step_seconds * SECOND
        lowest = F.ceil(F.greatest(t, begin) / F.lit(step)).cast("bigint") * step
        highest = F.least(F.coalesce(F.col("__next"), t + window), t + window, end) - 1
        answers = F.when(highest >= lowest, F.sequence(lowest, highest, F.lit(step).cast("bigint")))
    leads_at = F.greatest(t, F.col("__prev") + window)
    marks = F.concat(
        F.array(F.struct(leads_at.alias("at"), F.lit(0).alias("kind"))),
        F.coalesce(F.transform(answers, lambda at: F.struct(at.alias("at"), F.lit(1).alias("kind"))), _no_marks()),
    )
    points = rows.select(*keys, CHUNK, "__t", "__v", "__s", "__i", F.inline(marks))

    oldest = F.last(F.when(F.col("kind") == 0, F.struct("__t", "__v", "__s", "__i")), ignorenulls=True).over(
        part.orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    )
    points = points.withColumn("first", oldest).filter((F.col("kind") == 1) & (F.col("__i") > F.col("first.__i")))
    n = F.col("__i") - F.col("first.__i") + 1
    value = F.col("__s") - F.col("first.__s")
    if extrapolate:
        value = extrapolated(value, n, F.col("first.__t"), t, F.col("first.__v"), F.col("at") - window, F.col("at"))
    return points.select(*keys, _back_to(samples, F.col("at")).alias("ts"), value.alias("increase"))


def _no_marks() -> Column:
    return F.array().cast("array<struct<at: bigint, kind: int>>")


def _back_to(samples: DataFrame, at: Column) -> Column:
    """Epoch microseconds in the type of the table's own ``ts``."""
    return F.timestamp_micros(at).cast(samples.schema["ts"].dataType)


def counter_rate(samples: DataFrame, keys: Sequence[str], window_seconds: int, **options) -> DataFrame:
    """Per-second rate: the increase divided by the window."""
    found = counter_increase(samples, keys, window_seconds, **options)
    return found.select(*keys, "ts", (F.col("increase") / window_seconds).alias("rate"))


def increase_at(samples: DataFrame, keys: Sequence[str], at: str, window_seconds: int, extrapolate: bool = True) -> DataFrame:
    """Increase over the one window that ends at ``at``: one row per series, map-side aggregated."""
    end = micros(F.lit(at))
    t = micros("ts")
    inside = samples.filter((F.col("ts") > _shift(samples, at, window_seconds)) & (F.col("ts") <= _shift(samples, at, 0)))
    deltas = counter_deltas(inside, keys, chunk_seconds=max(window_seconds // 16, 60)).withColumn("__t", t)
    per_series = deltas.groupBy(*keys).agg(
        F.coalesce(F.sum("delta"), F.lit(0.0)).alias("__raw"),
        F.count(F.lit(1)).alias("__n"),
        F.min("__t").alias("__first"),
        F.max("__t").alias("__last"),
        F.min_by("value", "__t").alias("__v"),
    ).filter(F.col("__n") >= 2)
    value = F.col("__raw")
    if extrapolate:
        value = extrapolated(value, F.col("__n"), F.col("__first"), F.col("__last"), F.col("__v"), end - window_seconds * SECOND, end)
    return per_series.select(*keys, value.alias("increase"))


def _shift(samples: DataFrame, at: str, seconds: int) -> Column:
    """``at - seconds`` as a literal of the table's own time type, so it can reach the scan."""
    return F.lit(at).cast(samples.schema["ts"].dataType) - F.expr(f"INTERVAL {seconds} SECONDS")


# ------------------------------------------------------------------ ratios --


def ratio_by(vector: DataFrame, value: str, bad: Column, by: Sequence[str]) -> DataFrame:
    """Share of ``value`` that is ``bad`` per label set; no result where either side is absent."""
    sums = vector.groupBy(*by).agg(
        F.sum(F.when(bad, F.col(value))).alias("__num"), F.sum(value).alias("__den")
    )
    return sums.filter(F.col("__num").isNotNull() & F.col("__den").isNotNull()).select(
        *by, F.try_divide("__num", "__den").alias("ratio")
    )


def error_ratio(
    samples: DataFrame, keys: Sequence[str], window_seconds: int, step_seconds: int, by: Sequence[str] = (), code: str = "code"
) -> DataFrame:
    """Share of 5xx request rate at every grid time, optionally per label."""
    rates = counter_rate(samples, keys, window_seconds, step_seconds=step_seconds)
    return ratio_by(rates, "rate", full_match(F.col(code).cast("string"), "5.."), ["ts", *by])


# -------------------------------------------------------------- histograms --


def histogram_build(df: DataFrame, value: str, bounds: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Cumulative bucket counts per upper bound ``le``, always ending with +Inf: one scan, one grouping."""
    edges = [*sorted(bounds), math.inf]
    counts = df.groupBy(*by).agg(*[F.count_if(F.col(value) <= F.lit(e)).alias(f"__b{i}") for i, e in enumerate(edges)])
    buckets = F.array(*[F.struct(F.lit(float(e)).alias("le"), F.col(f"__b{i}").alias("bucket_count")) for i, e in enumerate(edges)])
    return counts.select(*by, F.inline(buckets))


def histogram_quantile(buckets: DataFrame, q: float, by: Sequence[str] = (), value: str = "bucket_count") -> DataFrame:
    """Quantile by linear interpolation inside the bucket that holds rank ``q * N``.

    Buckets are first summed per (labels, ``le``); what remains per label set
    is one row per bound. Without a +Inf bucket, with fewer than two buckets or
    without observations the result is NaN.
    """
    summed = buckets.groupBy(*by, "le").agg(F.sum(value).cast("double").alias("__n"))
    group = Window.partitionBy(*by).orderBy("le")
    whole = Window.partitionBy(*by)
    # Scrapes of different bounds may disagree slightly; cumulative counts never fall.
    summed = summed.withColumn("__n", F.max("__n").over(group.rowsBetween(Window.unboundedPreceding, 0)))
    edges = summed.withColumns(
        {
            "__lower": F.lag("le").over(group),
            "__below": F.coalesce(F.lag("__n").over(group), F.lit(0.0)),
            "__total": F.max("__n").over(whole),
            "__top": F.max("le").over(whole),
            "__buckets": F.count(F.lit(1)).over(whole),
        }
    ).withColumn("__rank", F.col("__total") * (q * (1 - RANK_SLACK)))
    usable = (F.col("__top") == F.lit(math.inf)) & (F.col("__buckets") >= 2) & (F.col("__total") > 0)
    holds = (F.col("__n") >= F.col("__rank")) & ((F.col("__below") < F.col("__rank")) | F.col("__lower").isNull())
    lower = F.coalesce("__lower", F.when(F.col("le") > 0, F.lit(0.0)))
    inside = F.col("__n") - F.col("__below")
    value_in = (
        F.when(F.col("le") == F.lit(math.inf), F.col("__lower"))
        .when(lower.isNull(), F.col("le"))
        .when(inside == 0, F.lit(math.nan))
        .otherwise(lower + (F.col("le") - lower) * (F.col("__rank") - F.col("__below")) / inside)
    )
    return edges.groupBy(*by).agg(F.coalesce(F.min(F.when(usable & holds, value_in)), F.lit(math.nan)).alias("quantile"))
