"""Streaming operators over the given tables, run to the end of the input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gatewright.operators import quality
from gatewright.plans.alert_queries import HOUR, SILENCE, UP_SQL, fire_sql
from gatewright.plans.metric_queries import SAMPLES_SQL, SERIES, grid_increase_sql
from gatewright.plans.registry import Tables, query
from gatewright.plans.source_queries import in_arrivals, out_of_order, run_arrivals, run_samples
from gatewright.session import shared_dir
from gatewright.streaming import alerts, dedup, gate, rates
from gatewright.streaming.sinks import AS_THEY_COME, append


def run_events(t: Tables, start: Callable[[DataFrame], StreamingQuery], number: Column | None = None) -> None:
    """Run a query over the events as they arrive: some late by default, or by ``number``."""

    def begin(path: str) -> StreamingQuery:
        stream = t.spark.readStream.schema(t.events.schema).option("recursiveFileLookup", "true").parquet(path)
        return start(stream.withColumn("ts", F.col("ts").cast("timestamp")))

    run_arrivals(t.spark, in_arrivals(t.events, out_of_order(F.col("event_id")) if number is None else number), begin)


def dedup_events(t: Tables, keys: list[str]) -> DataFrame:
    t, out = t.for_streams(), shared_dir(t.spark, "sink")

    def start(events: DataFrame) -> StreamingQuery:
        reads = events.select("user_id", "event_type", F.date_trunc("hour", "ts").alias("captured_at"), "event_id", "value")
        return append(dedup.stream_dedup(reads, keys, "captured_at", "2 hours", ["event_id"]), out, shared_dir(t.spark, "checkpoint"), AS_THEY_COME)

    run_events(t, start)
    return t.spark.read.parquet(out).withColumn("captured_at", F.col("captured_at").cast("timestamp_ntz"))


@query(
    """WITH r AS (SELECT user_id, event_type, date_trunc('hour', ts) AS captured_at, event_id, value FROM events)
    SELECT * FROM (SELECT DISTINCT ON (user_id, event_type, captured_at) * FROM r ORDER BY user_id, event_type, captured_at, event_id)
    WHERE captured_at <= (SELECT max(captured_at) FROM r) - INTERVAL 2 HOUR"""
)
def stream_dedup(t: Tables) -> DataFrame:
    return dedup_events(t, ["user_id", "event_type", "captured_at"])


KEPT_SECONDS = 400 * 24 * HOUR


@query("SELECT DISTINCT user_id, event_type FROM events WHERE ts IS NOT NULL")
def stream_dedup_untimed(t: Tables) -> DataFrame:
    """By a key without the event time, remembered for longer than the table reaches: later arrivals repeat nearly every key."""
    t, out = t.for_streams(), shared_dir(t.spark, "sink")

    def start(events: DataFrame) -> StreamingQuery:
        reads = events.filter("ts IS NOT NULL").select("user_id", "event_type", "ts")
        return append(dedup.stream_dedup(reads, ["user_id", "event_type"], "ts", f"{KEPT_SECONDS} seconds", []), out, shared_dir(t.spark, "checkpoint"), AS_THEY_COME)

    run_events(t, start)
    return t.spark.read.parquet(out).select("user_id", "event_type")


@query(
    f"""SELECT route, code, revision, ts, round(increase, 6) AS increase
    FROM {grid_increase_sql(SAMPLES_SQL, 'route, code, revision', 6 * HOUR, HOUR)}
    WHERE ts < (SELECT max(ts) FROM {SAMPLES_SQL}) - INTERVAL 1 HOUR"""
)
def stream_rate_windows(t: Tables) -> DataFrame:
    found = run_samples(t.for_streams(), lambda series: rates.stream_rate_windows(series, SERIES, 6 * HOUR, HOUR, HOUR))
    return found.select(*SERIES, F.col("ts").cast("timestamp_ntz").alias("ts"), F.round("increase", 6).alias("increase"))


@query(
    """SELECT CASE WHEN count(*) FILTER (NOT coalesce(value BETWEEN 0 AND 50, false)) = 0 AND count(*) = count(ts) THEN 'curated' ELSE 'quarantine' END AS place,
    batch, count(*)::BIGINT AS "rows", count(*) FILTER (NOT coalesce(value BETWEEN 0 AND 50, false))::BIGINT AS bad
    FROM (SELECT ts, value, least(greatest(coalesce(floor(value / 20), 0), 0), 3)::INTEGER AS batch FROM events) GROUP BY batch"""
)
def stream_quality_gate(t: Tables) -> DataFrame:
    """Arrivals by the size of the value: the first two pass, the others do not. Values below 0 or missing come with the first."""
    t, root = t.for_streams(), shared_dir(t.spark, "gate")
    suite = [quality.not_null("ts"), quality.between("value", 0, 50), quality.unique("event_id")]
    run_events(t, lambda events: gate.stream_quality_gate(events, suite, root, shared_dir(t.spark, "checkpoint"), AS_THEY_COME), F.floor(F.col("value") / 20))
    filed = t.spark.read.parquet(f"{root}/rows")
    bad = ~F.coalesce(F.col("value").between(0, 50), F.lit(False))
    return filed.groupBy("place", "batch").agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad"))


FIRED_SQL = fire_sql(UP_SQL, "user_id", "value", "value = 0", 2 * HOUR, "critical", "''", SILENCE).replace(", 'critical' AS severity, '' AS summary", "")


@query(f"SELECT * FROM ({FIRED_SQL}) WHERE ts <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR")
def stream_alerts(t: Tables) -> DataFrame:
    t, root = t.for_streams(), shared_dir(t.spark, "alerts")
    down = F.col("value") == 0

    def start(events: DataFrame) -> StreamingQuery:
        up = events.select("user_id", "ts", F.when(F.col("event_type") == "error", 0.0).otherwise(1.0).alias("value"))
        return alerts.stream_alerts(up, ["user_id"], down, 2 * HOUR, root, shared_dir(t.spark, "checkpoint"), SILENCE, HOUR, AS_THEY_COME)

    run_events(t, start)
    return t.spark.read.parquet(f"{root}/alerts").select(
        "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("active_since").cast("timestamp_ntz").alias("active_since"), "value"
    )
