"""Streams in several micro-batches against the batch operators."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from gatewright.operators import alerts, metrics, quality
from gatewright.sources.samples import samples_stream
from gatewright.streaming import alerts as stream_alerts_module
from gatewright.streaming import dedup, gate, rates
from gatewright.streaming.sinks import drain, keyed_state

T0 = datetime(2026, 9, 1)
SCHEMA = "s string, ts timestamp, value double"


def arrive(spark, folder, batches):
    """One file per batch, in order of arrival."""
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return samples_stream(spark, folder, SCHEMA, files_per_trigger=1)


def points(seed, n=240):
    rng = random.Random(seed)
    value, rows = {"a": 0, "b": 0}, []
    for i in range(n):
        for s in value:
            value[s] = 0 if rng.random() < 0.05 else value[s] + rng.randrange(5)
            rows.append((s, T0 + timedelta(seconds=15 * i), float(value[s])))
    return rows


def split(rows, size):
    return [rows[i : i + size] for i in range(0, len(rows), size)]


def fired(spark, tmp_path, condition, for_seconds, gap=None, delay=60):
    stream_alerts_module.stream_alerts(
        stream(spark, f"{tmp_path}/in"), ["s"], condition, for_seconds, f"{tmp_path}/out", f"{tmp_path}/cp", gap, delay
    ).awaitTermination()
    return spark.read.parquet(f"{tmp_path}/out/alerts").select("s", "ts", "active_since").collect()


def test_alerts_over_files_out_of_order_equal_batch(spark, tmp_path):
    rows = points(1)
    rng = random.Random(7)
    shuffled = sorted(rows, key=lambda r: (r[1] + timedelta(seconds=rng.randrange(0, 120)), r[0]))
    arrive(spark, f"{tmp_path}/in", split(shuffled, 96))
    on = (F.col("value") % 4) != 0
    got = fired(spark, tmp_path, on, 45, 40, delay=150)
    batch = alerts.sustained_for(spark.createDataFrame(rows, SCHEMA), ["s"], on, 45, 40).filter("firing").select("s", "ts", "active_since")
    expected = [r for r in batch.collect() if r.ts <= max(r[1] for r in rows) - timedelta(seconds=150)]
    assert sorted(got) == sorted(expected) and len(got) > 20


def test_late_off_evaluations_prevent_an_alert(spark, tmp_path):
    minute = lambda m, v: ("a", T0 + timedelta(minutes=m), v)
    arrive(spark, f"{tmp_path}/in", [[minute(m, 1.0) for m in (0, 1, 4, 5)], [minute(2, 0.0), minute(3, 0.0)], [minute(30, 0.0)]])
    assert fired(spark, tmp_path, F.col("value") == 1, 180, delay=300) == []


def test_evaluations_behind_the_watermark_are_dropped(spark, tmp_path):
    late = [("a", T0 - timedelta(hours=1), 1.0), ("a", T0 + timedelta(seconds=120), 1.0)]
    arrive(spark, f"{tmp_path}/in", [[("a", T0, 1.0)], late, [("a", T0 + timedelta(seconds=400), 0.0)]])
    got = fired(spark, tmp_path, F.col("value") == 1, 60)
    assert [(r.ts, r.active_since) for r in got] == [(T0 + timedelta(seconds=120), T0)]


def test_alerts_go_on_after_a_restart(spark, tmp_path):
    rows = points(5)
    on = (F.col("value") % 4) != 0
    for part in split(rows, 160):  # every call is a query of its own, from the same checkpoint
        arrive(spark, f"{tmp_path}/in", [part])
        got = fired(spark, tmp_path, on, 45, 40, delay=30)
    batch = alerts.sustained_for(spark.createDataFrame(rows, SCHEMA), ["s"], on, 45, 40).filter("firing").select("s", "ts", "active_since")
    expected = [r for r in batch.collect() if r.ts <= max(r[1] for r in rows) - timedelta(seconds=30)]
    assert sorted(got) == sorted(expected) and len(got) > 20


def test_alerts_keep_other_columns_and_null_keys(spark, tmp_path):
    folder, kinds = f"{tmp_path}/in", "s STRING, ts TIMESTAMP, value DOUBLE, n BIGINT, seen TIMESTAMP, tags MAP<STRING, INT>, at INT"
    rows = [(s, T0 + timedelta(minutes=m), 1.0, None if m % 2 else 2**62 + m, T0, {"a": m}, m) for s in ("a", None) for m in range(6)]
    spark.createDataFrame([*rows, ("a", None, 1.0, 1, T0, None, 1), ("z", T0 + timedelta(hours=1), 0.0, 1, None, {}, 1)], kinds).coalesce(1).write.parquet(folder)
    frame = samples_stream(spark, folder, kinds, files_per_trigger=1)
    stream_alerts_module.stream_alerts(frame, ["s"], F.col("value") == 1, 180, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out/alerts")
    assert got.columns == [*frame.columns, "active_since"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((*r, T0) for r in rows if r[-1] >= 3), key=repr)


def test_rates_count_restarts_inside_an_interval(spark, tmp_path):
    rng, value, rows = random.Random(3), 0, []
    for i in range(400):
        value = 0 if rng.random() < 0.1 else value + rng.randrange(9)
        rows.append(("a", T0 + timedelta(seconds=5 * i), float(value)))
    arrive(spark, f"{tmp_path}/in", split(rows, 90))
    with keyed_state(spark):
        drain(rates.stream_rate_windows(stream(spark, f"{tmp_path}/in"), ["s"], 300, 60, 30), f"{tmp_path}/out", f"{tmp_path}/cp")
    got = {r.ts: r.increase for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    batch = {r.ts: r.increase for r in metrics.counter_increase(spark.createDataFrame(rows, SCHEMA), ["s"], 300, 60).collect()}
    assert len(got) > 25 and all(abs(got[k] - batch[k]) < 1e-6 for k in got)


def test_rate_windows_equal_batch_on_closed_windows(spark, tmp_path):
    rows = points(2)
    arrive(spark, f"{tmp_path}/in", split(rows, 160))
    found = rates.stream_rate_windows(stream(spark, f"{tmp_path}/in"), ["s"], 300, 60, 30)
    with keyed_state(spark):
        drain(found, f"{tmp_path}/out", f"{tmp_path}/cp")
    got = {(r.s, r.ts): r.increase for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    batch = {(r.s, r.ts): r.increase for r in metrics.counter_increase(spark.createDataFrame(rows, SCHEMA), ["s"], 300, 60).collect()}
    closed = max(r[1] for r in rows) - timedelta(seconds=30)
    expected = {k: v for k, v in batch.items() if k[1] < closed}
    assert got.keys() == expected.keys() and len(got) > 80
    assert all(abs(got[k] - expected[k]) < 1e-6 for k in got)


def test_long_windows_with_short_steps_silence_and_lateness(spark, tmp_path):
    rng, value, rows = random.Random(8), 0, []
    for i in range(500):
        value = 0 if rng.random() < 0.03 else value + rng.randrange(9)
        if not 200 <= i < 320:  # silent for half an hour
            rows.append(("a", T0 + timedelta(seconds=15 * i + rng.randrange(3)), float(value)))
    rows.append(("z", T0 + timedelta(seconds=15 * 520), 1.0))
    shuffled = sorted(rows, key=lambda r: r[1] + timedelta(seconds=rng.randrange(100)))
    for part in split(shuffled, 130):  # a restart from the checkpoint each time
        arrive(spark, f"{tmp_path}/in", [part])
        with keyed_state(spark):
            drain(rates.stream_rate_windows(stream(spark, f"{tmp_path}/in"), ["s"], 3600, 15, 120), f"{tmp_path}/out", f"{tmp_path}/cp")
    got = {(r.s, r.ts): r.increase for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    batch = {(r.s, r.ts): r.increase for r in metrics.counter_increase(spark.createDataFrame(rows, SCHEMA), ["s"], 3600, 15).collect()}
    closed = max(r[1] for r in rows) - timedelta(seconds=120)
    expected = {k: v for k, v in batch.items() if k[1] < closed}
    assert got.keys() == expected.keys() and len(got) > 400
    assert all(abs(got[k] - expected[k]) < 1e-6 for k in got)


def test_dedup_by_a_key_without_time(spark, tmp_path):
    at = lambda m: T0 + timedelta(minutes=m)
    arrive(spark, f"{tmp_path}/in", [
        [("a", at(0), 1.0), ("b", at(1), 1.0)],
        [("a", at(8), 2.0), ("c", at(9), 2.0)],  # a repeat in a later batch
        [("a", at(30), 3.0), ("b", at(5), 3.0)],  # a new row of a's, ten minutes after the first; a late repeat of b
        [("d", at(2), 4.0), ("a", at(35), 4.0)],  # behind the watermark; a repeat
    ])
    drain(dedup.stream_dedup(stream(spark, f"{tmp_path}/in"), ["s"], "ts", "10 minutes", ["value"]), f"{tmp_path}/out", f"{tmp_path}/cp")
    got = sorted((r.s, r.value) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    print(got)
    assert got[:1] == [("a", 1.0)] and ("b", 1.0) in got and ("c", 2.0) in got and ("a", 2.0) not in got and ("b", 3.0) not in got and ("a", 4.0) not in got


def test_dedup_keeps_the_first_over_batches(spark, tmp_path):
    rng = random.Random(4)
    rows = [("ab"[i % 2], T0 + timedelta(minutes=i // 8), float(v)) for i, v in enumerate(rng.sample(range(1000), 160))]
    arrive(spark, f"{tmp_path}/in", [rows[20:90], rows[:20] + rows[70:120], rows[120:]])
    drain(dedup.stream_dedup(stream(spark, f"{tmp_path}/in"), ["s", "ts"], "ts", "15 minutes", ["value"]), f"{tmp_path}/out", f"{tmp_path}/cp")
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").select("s", "ts", "value").collect()))
    closed = max(r[1] for r in rows) - timedelta(minutes=15)
    expected = sorted((s, ts, min(v for a, b, v in rows if (a, b) == (s, ts))) for s, ts in {r[:2] for r in rows} if ts <= closed)
    assert got == expected and len(got) > 5


def test_quality_gate_sorts_batches(spark, tmp_path):
    good, bad = [("a", T0, 1.0), ("b", T0, 2.0)], [("a", T0, 1.0), ("b", T0, 99.0)]
    arrive(spark, f"{tmp_path}/in", [good, bad, good])
    gate.stream_quality_gate(stream(spark, f"{tmp_path}/in"), [quality.between("value", 0, 10)], f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/out/rows").collect()
    assert sorted((r.place, r.batch, r.value) for r in rows) == [
        ("curated", 0, 1.0), ("curated", 0, 2.0), ("curated", 2, 1.0), ("curated", 2, 2.0), ("quarantine", 1, 1.0), ("quarantine", 1, 99.0),
    ]
    reports = {r.batch_id: r.success for r in spark.read.option("recursiveFileLookup", "true").json(f"{tmp_path}/out/reports").collect()}
    assert reports == {0: True, 1: False, 2: True}
