"""Alert rules: a threshold that has held for long enough."""

from __future__ import annotations

import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from gatewright.functions.chunks import (
    CHUNK,
    LEAD,
    by_chunk,
    in_chunk,
    micros,
    rows_before,
    rows_upto,
    time_chunk,
    with_opening,
    without_leads,
)
from gatewright.functions.labels import alert_text
from gatewright.operators.metrics import DAY, HOUR, SECOND, counter_increase, counter_rate, error_ratio, histogram_quantile

_OPS = {"==": operator.eq, "!=": operator.ne, ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}

MINUTE = 60
# How long a sample speaks for its series: after that the series counts as absent, which resets an alert.
LOOKBACK = 5 * MINUTE

# Severity and summary text of each rule.
API_DOWN = ("critical", "dataset-api is not being scraped")
HIGH_ERROR_RATE = ("warning", "dataset-api 5xx rate above 5%")
SLOW_P95 = ("warning", "p95 latency above 500ms on {route}")
QUALITY_FAILING = ("warning", "A dataset version failed its expectation suite in the last hour")
FREEZE_BLOCKED = ("warning", "The quality gate has blocked more than 3 freezes in 6 hours")
DRIFT = ("warning", "Drift on {feature} for model {model}")
CANARY_BURN = ("critical", "Contender revision {revision} exceeding 2% errors — promotion should be blocked")


def over_limit(value: Column, op: str, limit: float) -> Column:
    return F.coalesce(_OPS[op](value, F.lit(limit)) & ~F.isnan(value.cast("double")), F.lit(False))


def threshold_alert(df: DataFrame, value: str, op: str, limit: float) -> DataFrame:
    """Keep the rows whose value passes the comparison; NaN never does."""
    return df.filter(over_limit(F.col(value), op, limit))


def evaluate_runs(
    df: DataFrame,
    keys: Sequence[str],
    condition: Column,
    max_gap_seconds: int | None = None,
    chunk_seconds: int = DAY,
    state: DataFrame | None = None,
) -> DataFrame:
    """Every evaluation (``ts``) with ``is_on`` and, while on, ``active_since``.

    ``state`` holds the last known evaluation per key (``ts``, ``is_on``,
    ``active_since``) from earlier data; runs continue from it.
    """
    given = F.lit(None).cast(df.schema["ts"].dataType)
    rows = df.withColumns({"is_on": F.coalesce(condition, F.lit(False)), "__start": given, "__state": F.lit(False)})
    if state is not None:
        earlier = state.select(*keys, "ts", "is_on", F.col("active_since").alias("__start"), F.lit(True).alias("__state"))
        rows = rows.unionByName(earlier, allowMissingColumns=True)
    rows = rows.withColumn(CHUNK, time_chunk("ts", chunk_seconds))

    def broken(was_on: Column, was_ts: Column) -> Column:
        """The run before this row has ended."""
        ended = ~F.coalesce(was_on, F.lit(False))
        if max_gap_seconds is None:
            return ended
        return ended | F.coalesce(micros("ts") - micros(was_ts) > max_gap_seconds * SECOND, F.lit(False))

    def started(window: WindowSpec) -> Column:
        """Start of the run a row opens: an earlier state's own start, or the row's time."""
        opens = broken(F.lag("is_on").over(window), F.lag("ts").over(window))
        return F.when(F.col("is_on"), F.when(F.col("__state"), F.col("__start")).when(opens, F.col("ts")))

    # A chunk closes with its last evaluation and its last start. Whether its first row
    # starts a run depends on the chunk before, so that row is settled among the chunks.
    alone = in_chunk(keys, ["ts"], lead=False)
    core = by_chunk(rows.select(*keys, CHUNK, "ts", "is_on", "__start", "__state"), keys)
    first = F.lag("ts").over(alone).isNull() & ~F.col("__state")
    closing = (
        core.withColumns({"__begun": started(alone), "__first": first})
        .groupBy(*keys, CHUNK)
        .agg(
            F.min("ts").alias("__first_ts"),
            F.max(F.col("__first") & F.col("is_on")).alias("__first_on"),
            F.max(F.when(~F.col("__first"), F.col("__begun"))).alias("__start"),
            F.max("ts").alias("__last_ts"),
            F.max_by("is_on", "ts").alias("__last_on"),
        )
    )

    def opening(ends: DataFrame, along: WindowSpec) -> DataFrame:
        carried = ends.withColumns(
            {"is_on": F.lag("__last_on").over(along), "was_ts": F.lag("__last_ts").over(along), "ts": F.col("__first_ts")}
        )
        settled = F.when(F.col("__first_on") & broken(F.col("is_on"), F.col("was_ts")), F.col("ts"))
        latest = F.last("__start", ignorenulls=True).over(rows_before(along))
        return (
            carried.withColumn("__start", F.coalesce("__start", settled))
            .withColumns({"__start": latest, "ts": F.col("was_ts"), "__state": F.lit(False)})
        )

    window = in_chunk(keys, ["ts"])
    scanned = with_opening(rows, keys, closing, opening)
    scanned = scanned.withColumn("__start", F.when(F.col(LEAD) == 0, F.col("__start")).otherwise(started(window)))
    since = F.last("__start", ignorenulls=True).over(rows_upto(window))
    runs = without_leads(scanned.withColumn("active_since", F.when(F.col("is_on"), since))).drop("__start")
    return runs if state is not None else runs.drop("__state")


def held_for(for_seconds: int) -> Column:
    return micros("ts") - micros("active_since") >= for_seconds * SECOND


def sustained_for(
    df: DataFrame,
    keys: Sequence[str],
    condition: Column,
    for_seconds: int,
    max_gap_seconds: int | None = None,
    chunk_seconds: int = DAY,
) -> DataFrame:
    """Evaluations (``ts``) where ``condition`` holds, with ``active_since`` and ``firing``.

    ``firing`` is true once the condition has held without a break for the
    duration. A false evaluation breaks the run; so does a silence longer than
    ``max_gap_seconds``, because an expression without a result resets its alert.
    """
    runs = evaluate_runs(df, keys, condition, max_gap_seconds, chunk_seconds)
    return runs.filter("is_on").withColumn("firing", held_for(for_seconds)).drop("is_on")


def fire(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    op: str,
    limit: float,
    for_seconds: int,
    text: tuple[str, str],
    max_gap_seconds: int | None = None,
) -> DataFrame:
    """Firing evaluations of one rule, with its severity and summary (``text``)."""
    severity, summary = text
    held = sustained_for(df, keys, over_limit(F.col(value), op, limit), for_seconds, max_gap_seconds)
    return held.filter("firing").select(
        *keys,
        "ts",
        "active_since",
        F.col(value).alias("value"),
        F.lit(severity).alias("severity"),
        alert_text(summary, **{k: F.col(k) for k in keys}).alias("summary"),
    )


def alert_api_down(up: DataFrame, keys: Sequence[str], for_seconds: int = 2 * MINUTE, max_gap_seconds: int | None = LOOKBACK) -> DataFrame:
    """A scrape target reports ``up == 0``. A silence longer than ``max_gap_seconds`` ends a run."""
    return fire(up, keys, "value", "==", 0.0, for_seconds, API_DOWN, max_gap_seconds)


def alert_high_error_rate(
    requests: DataFrame,
    keys: Sequence[str],
    window_seconds: int = 5 * MINUTE,
    step_seconds: int = 15,
    limit: float = 0.05,
    for_seconds: int = 5 * MINUTE,
) -> DataFrame:
    """5xx share of all requests above the limit."""
    ratio = error_ratio(requests, keys, window_seconds, step_seconds)
    return fire(ratio, [], "ratio", ">", limit, for_seconds, HIGH_ERROR_RATE, step_seconds)


def p95_by_route(buckets: DataFrame, keys: Sequence[str], window_seconds: int, step_seconds: int, q: float = 0.95) -> DataFrame:
    """95th percentile latency per route at every grid time, from bucket counters (``le`` in ``keys``)."""
    rates = counter_rate(buckets, keys, window_seconds, step_seconds=step_seconds)
    return histogram_quantile(rates, q, ["ts", "route"], value="rate")


def alert_slow_p95(
    buckets: DataFrame,
    keys: Sequence[str],
    window_seconds: int = 5 * MINUTE,
    step_seconds: int = 15,
    limit: float = 0.5,
    for_seconds: int = 10 * MINUTE,
) -> DataFrame:
    """p95 latency of a route above the limit."""
    p95 = p95_by_route(buckets, keys, window_seconds, step_seconds)
    return fire(p95, ["route"], "quantile", ">", limit, for_seconds, SLOW_P95, step_seconds)


def alert_quality_failing(
    failures: DataFrame, keys: Sequence[str], step_seconds: int = 15, window_seconds: int = HOUR, for_seconds: int = MINUTE
) -> DataFrame:
    """Any suite failure within the window."""
    grown = counter_increase(failures, keys, window_seconds, step_seconds)
    return fire(grown, keys, "increase", ">", 0.0, for_seconds, QUALITY_FAILING, step_seconds)


def alert_freeze_blocked(
    rejections: DataFrame,
    keys: Sequence[str],
    step_seconds: int = 15,
    window_seconds: int = 6 * HOUR,
    limit: float = 3.0,
    for_seconds: int = 5 * MINUTE,
) -> DataFrame:
    """More than ``limit`` refused freezes within the window."""
    grown = counter_increase(rejections, keys, window_seconds, step_seconds)
    return fire(grown, keys, "increase", ">", limit, for_seconds, FREEZE_BLOCKED, step_seconds)


def alert_drift(scores: DataFrame, limit: float = 0.3, for_seconds: int = 15 * MINUTE, max_gap_seconds: int | None = LOOKBACK) -> DataFrame:
    """Drift score of a (feature, model) above the limit. A silence longer than ``max_gap_seconds`` ends a run."""
    return fire(scores, ["feature", "model"], "value", ">", limit, for_seconds, DRIFT, max_gap_seconds)


def alert_canary_burn(
    requests: DataFrame,
    keys: Sequence[str],
    window_seconds: int = 5 * MINUTE,
    step_seconds: int = 15,
    limit: float = 0.02,
    for_seconds: int = 5 * MINUTE,
) -> DataFrame:
    """5xx share of one revision above the limit."""
    ratio = error_ratio(requests, keys, window_seconds, step_seconds, by=["revision"])
    return fire(ratio, ["revision"], "ratio", ">", limit, for_seconds, CANARY_BURN, step_seconds)
