"""Alert rules and the promotion verdict on the given tables.

Windows and durations are hours rather than minutes, because events are
minutes apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewright.operators import alerts, canary, catalog, drift, metrics
from gatewright.plans.catalog_queries import FOLD_SQL, action_log, log_versions
from gatewright.plans.metric_queries import (
    FEATURES,
    GRID,
    HOUR,
    REQUESTS_SQL,
    SERIES,
    bucket_counter_sql,
    bucket_samples,
    count_samples,
    counter_sql,
    grid_increase_sql,
    psi_sql,
    quantile_sql,
    ratio_sql,
    request_samples,
    requests,
    window_increase_sql,
)
from gatewright.plans.registry import Tables, query

DAY = 24 * HOUR
STEP = GRID[1]
# Events of a user are hours apart, so a silence is longer here than between scrapes.
SILENCE = 12 * HOUR


def sustained_sql(source: str, keys: str, condition: str, seconds: int, gap: int | None = None) -> str:
    """Runs of true evaluations; a false one or a long silence starts a new run."""
    part = f"PARTITION BY {keys}" if keys else ""
    silent = f" OR epoch_us(ts) - lag(epoch_us(ts)) OVER w > {gap}000000" if gap else ""
    inner = f"PARTITION BY {keys}, run" if keys else "PARTITION BY run"
    return f"""(SELECT * EXCLUDE (run, is_on, breaks), min(ts) OVER ({inner}) AS active_since,
        epoch_us(ts) - epoch_us(min(ts) OVER ({inner})) >= {seconds}::BIGINT * 1000000 AS firing
      FROM (SELECT *, sum(CASE WHEN breaks THEN 1 ELSE 0 END) OVER ({part} ORDER BY ts) AS run
        FROM (SELECT *, NOT is_on OR coalesce(NOT lag(is_on) OVER w{silent}, true) AS breaks
          FROM (SELECT *, coalesce({condition}, false) AS is_on FROM {source}) WINDOW w AS ({part} ORDER BY ts)))
      WHERE is_on)"""


def fire_sql(source: str, keys: str, value: str, condition: str, seconds: int, severity: str, summary: str, gap: int | None = None) -> str:
    lead = f"{keys}, " if keys else ""
    return f"""SELECT {lead}ts, active_since, round({value}, 6) AS value, '{severity}' AS severity, {summary} AS summary
      FROM {sustained_sql(source, keys, condition, seconds, gap)} WHERE firing"""


def tidy(fired: DataFrame) -> DataFrame:
    return fired.withColumn("value", F.round("value", 6))


@query("SELECT event_id, value FROM events WHERE value > 100")
def threshold_alert(t: Tables) -> DataFrame:
    return alerts.threshold_alert(t.events, "value", ">", 100.0).select("event_id", "value")


@query(
    "SELECT user_id, ts, event_type, active_since, firing FROM "
    + sustained_sql("(SELECT user_id, ts, event_type FROM events)", "user_id", "event_type IN ('error', 'view')", 2 * HOUR, DAY)
)
def sustained_for(t: Tables) -> DataFrame:
    return alerts.sustained_for(
        t.events.select("user_id", "ts", "event_type"), ["user_id"], F.col("event_type").isin("error", "view"), 2 * HOUR, DAY
    )


UP_SQL = "(SELECT user_id, ts, CASE event_type WHEN 'error' THEN 0.0 ELSE 1.0 END::DOUBLE AS value FROM events)"


def up_samples(t: Tables) -> DataFrame:
    return t.events.select("user_id", "ts", F.when(F.col("event_type") == "error", 0.0).otherwise(1.0).alias("value"))


@query(fire_sql(UP_SQL, "user_id", "value", "value = 0", 2 * HOUR, "critical", "'dataset-api is not being scraped'", SILENCE))
def alert_api_down(t: Tables) -> DataFrame:
    return tidy(alerts.alert_api_down(up_samples(t), ["user_id"], 2 * HOUR, SILENCE))


@query(
    fire_sql(ratio_sql("ts"), "", "ratio", "ratio > 0.05", HOUR, "warning", "'dataset-api 5xx rate above 5%'", STEP)
)
def alert_high_error_rate(t: Tables) -> DataFrame:
    return tidy(alerts.alert_high_error_rate(request_samples(t), SERIES, *GRID, for_seconds=HOUR))


@query(
    fire_sql(
        quantile_sql(grid_increase_sql(bucket_counter_sql("route"), "route, le", *GRID), "ts, route", "increase", 0.95),
        "route", "quantile", "quantile > 60", 2 * HOUR, "warning", "'p95 latency above 500ms on ' || route", STEP,
    )
)
def alert_slow_p95(t: Tables) -> DataFrame:
    return tidy(
        alerts.alert_slow_p95(bucket_samples(t, ["route"]), ["route", "le"], *GRID, limit=60.0, for_seconds=2 * HOUR)
    )


FAILURES_SQL = """(SELECT dataset, ts, count(*) OVER (PARTITION BY dataset ORDER BY ts)::DOUBLE AS value FROM outcomes
    WHERE action = 'quality' AND outcome = 'ok' AND status = 'failed')"""
REJECTIONS_SQL = """(SELECT dataset, ts, count(*) OVER (PARTITION BY dataset ORDER BY ts)::DOUBLE AS value FROM outcomes
    WHERE action = 'freeze' AND outcome = 'quality_not_passed')"""


def folded(t: Tables) -> DataFrame:
    return catalog.fold_actions(action_log(t), log_versions(t))


@query(
    FOLD_SQL
    + fire_sql(
        grid_increase_sql(FAILURES_SQL, "dataset", 6 * HOUR, STEP), "dataset", "increase", "increase > 0", HOUR, "warning",
        "'A dataset version failed its expectation suite in the last hour'", STEP,
    )
)
def alert_quality_failing(t: Tables) -> DataFrame:
    failures = metrics.quality_failures_total(folded(t))
    return tidy(alerts.alert_quality_failing(failures, ["dataset"], STEP, 6 * HOUR, HOUR))


@query(
    FOLD_SQL
    + fire_sql(
        grid_increase_sql(REJECTIONS_SQL, "dataset", 7 * DAY, STEP), "dataset", "increase", "increase > 3", HOUR, "warning",
        "'The quality gate has blocked more than 3 freezes in 6 hours'", STEP,
    )
)
def alert_freeze_blocked(t: Tables) -> DataFrame:
    rejections = metrics.freeze_rejected_total(folded(t))
    return tidy(alerts.alert_freeze_blocked(rejections, ["dataset"], STEP, 7 * DAY, 3.0, HOUR))


@query(
    fire_sql(
        f"(SELECT l_shipdate AS ts, feature, 'price' AS model, psi AS value FROM {psi_sql('lineitem', 'l_shipdate')})",
        "feature, model", "value", "value > 0.3", 2 * DAY, "warning",
        "'Drift on ' || feature || ' for model ' || model", DAY,
    )
)
def alert_drift(t: Tables) -> DataFrame:
    before = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    daily = drift.psi(t.lineitem.filter(before), t.lineitem, FEATURES, by=["l_shipdate"])
    scores = daily.select(F.col("l_shipdate").alias("ts"), "feature", F.lit("price").alias("model"), F.col("psi").alias("value"))
    return tidy(alerts.alert_drift(scores, 0.3, 2 * DAY, DAY))


@query(
    fire_sql(
        ratio_sql("ts, revision"), "revision", "ratio", "ratio > 0.02", HOUR, "critical",
        "'Contender revision ' || revision::VARCHAR || ' exceeding 2% errors — promotion should be blocked'", STEP,
    )
)
def alert_canary_burn(t: Tables) -> DataFrame:
    return tidy(alerts.alert_canary_burn(request_samples(t), SERIES, *GRID, for_seconds=HOUR))


# --------------------------------------------------------------- promotion --

AT, WINDOW = "2024-01-20 12:00:00", 10 * DAY


@query(
    f"""SELECT service,
    max(n) FILTER (role = 'champion')::BIGINT AS champion_n, max(n) FILTER (role = 'contender')::BIGINT AS contender_n,
    max(worst) FILTER (role = 'champion') AS champion_worst, max(worst) FILTER (role = 'contender') AS contender_worst
    FROM (SELECT service, role, count(*) AS n, max(value) AS worst FROM {REQUESTS_SQL} GROUP BY ALL) GROUP BY 1"""
)
def canary_pair(t: Tables) -> DataFrame:
    stats = requests(t).groupBy("service", "role").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("worst"))
    return canary.canary_pair(stats, ["n", "worst"])


def at_increase_sql(samples: str, keys: str) -> str:
    w = WINDOW * 1_000_000
    listed = f"""SELECT {keys}, value, epoch_us(ts) AS t, epoch_us(TIMESTAMP '{AT}') AS gt FROM {samples}
      WHERE epoch_us(ts) > epoch_us(TIMESTAMP '{AT}') - {w} AND ts <= TIMESTAMP '{AT}'"""
    return window_increase_sql(listed, keys, w)


COUNTS_SQL = counter_sql(REQUESTS_SQL, "service, role, code")
P95_SQL = quantile_sql(at_increase_sql(bucket_counter_sql("service, role"), "service, role, le"), "service, role", "increase", 0.95)


@query(
    f"""
WITH r AS (SELECT service, role, sum(increase) AS requests,
    coalesce(sum(increase) FILTER (code >= 500), 0) / {WINDOW} / greatest(sum(increase) / {WINDOW}, 0.001) AS error_rate
    FROM {at_increase_sql(COUNTS_SQL, 'service, role, code')} GROUP BY ALL),
s AS (SELECT * FROM r FULL JOIN (SELECT service, role, quantile AS p95 FROM {P95_SQL}) USING (service, role)),
p AS (SELECT service, {', '.join(f"max({v}) FILTER (role = '{side}') AS {side}_{v}" for side in ('champion', 'contender') for v in ('requests', 'error_rate', 'p95'))}
  FROM s GROUP BY 1)
SELECT service, {', '.join(f'round({side}_{v}, 6) AS {side}_{v}' for side in ('champion', 'contender') for v in ('requests', 'error_rate', 'p95'))},
  CASE WHEN coalesce(contender_requests, 0) < 230 OR contender_error_rate IS NULL OR champion_error_rate IS NULL THEN 'HOLD'
    WHEN contender_error_rate > champion_error_rate + 0.01 OR coalesce(contender_p95 > champion_p95 * 1.01, false) THEN 'ROLLBACK' ELSE 'PROMOTE' END AS decision,
  CASE WHEN coalesce(contender_requests, 0) < 230 THEN printf('%.2f requests to the contender, fewer than 230', coalesce(contender_requests, 0))
    WHEN contender_error_rate IS NULL OR champion_error_rate IS NULL THEN 'contender or champion has no error rate'
    WHEN contender_error_rate > champion_error_rate + 0.01 THEN printf('errors: %.4f of the contender''s requests, %.4f of the champion''s, 0.01 more allowed', contender_error_rate, champion_error_rate)
    WHEN coalesce(contender_p95 > champion_p95 * 1.01, false) THEN printf('latency: p95 %.1f of the contender, %.1f of the champion, factor 1.01 allowed', contender_p95, champion_p95)
    ELSE 'errors and latency as good as the champion''s' END AS reason
FROM p"""
)
def promotion_verdict(t: Tables) -> DataFrame:
    counts = count_samples(t, ["service", "role", "code"]).withColumnRenamed("code", "response_code")
    buckets = bucket_samples(t, ["service", "role"])
    stats = canary.revision_statistics(counts, buckets, AT, WINDOW)
    found = canary.promotion_verdict(stats, min_requests=230, tolerance=0.01)
    numbers = [c for c in found.columns if c.startswith(("champion", "contender"))]
    return found.withColumns({c: F.round(c, 6) for c in numbers})


