"""Counters, rates, histograms, runs and verdicts against hand values and brute force."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gatewright.functions import labels
from gatewright.functions.chunks import ordered_scan, time_chunk
from gatewright.operators import alerts, canary, drift, metrics

T0 = datetime(2026, 9, 1)
SAMPLES = "s string, ts timestamp, value double"


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def samples(spark, series):
    return spark.createDataFrame([(s, at(t), float(v)) for s, points in series.items() for t, v in points], SAMPLES)


def brute_increase(points, end, window, extrapolate=True):
    inside = [(t, v) for t, v in sorted(points) if end - window < t <= end]
    if len(inside) < 2:
        return None
    raw = sum(b if b < a else b - a for (_, a), (_, b) in zip(inside, inside[1:]))
    if not extrapolate:
        return raw
    (first, v0), last = inside[0], inside[-1][0]
    sampled, gap = last - first, (last - first) / (len(inside) - 1)
    head, tail = first - (end - window), end - last
    head = gap / 2 if head >= 1.1 * gap else head
    tail = gap / 2 if tail >= 1.1 * gap else tail
    if raw > 0 and v0 >= 0:
        head = min(head, sampled * v0 / raw)
    return raw * (sampled + head + tail) / sampled


def test_increase_by_hand(spark):
    # 100 -> 160 in 60 s inside a 75 s window: 15 s to the start, none to the end.
    df = samples(spark, {"a": [(-15, 90), (0, 100), (15, 110), (30, 130), (45, 150), (60, 160)]})
    rows = {r.ts: r.increase for r in metrics.counter_increase(df, ["s"], 75).collect()}
    assert rows[at(60)] == pytest.approx(60 * 75 / 60)
    plain = {r.ts: r.increase for r in metrics.counter_increase(df, ["s"], 75, extrapolate=False).collect()}
    assert plain[at(60)] == 60.0
    assert at(-15) not in plain


def test_increase_needs_two_samples_and_sees_restarts(spark):
    df = samples(spark, {"one": [(0, 5)], "reset": [(0, 100), (15, 110), (30, 4), (45, 9)]})
    rows = [(r.s, r.ts, r.increase) for r in metrics.counter_increase(df, ["s"], 300, extrapolate=False).collect()]
    assert ("reset", at(45), 19.0) in rows and not [r for r in rows if r[0] == "one"]


@pytest.mark.parametrize("step", [None, 15, 60])
@pytest.mark.parametrize("extrapolate", [True, False])
def test_increase_equals_brute_force_across_chunks(spark, step, extrapolate):
    rng = random.Random(3)
    series = {}
    for name in "abc":
        t, v, points = 86_400 - 3000, 0, []
        while t < 86_400 + 3000:
            t += rng.choice([1, 15, 15, 15, 200, 700])
            v = 0 if rng.random() < 0.1 else v + rng.randrange(10)
            points.append((t, v))
        series[name] = points
    found = {
        (r.s, int((r.ts - T0).total_seconds())): r.increase
        for r in metrics.counter_increase(samples(spark, series), ["s"], 300, step, extrapolate).collect()
    }
    expected = {}
    for name, points in series.items():
        times = [t for t, _ in points] if step is None else range(0, 3 * 86_400, step)
        for t in times:
            value = brute_increase(points, t, 300, extrapolate)
            if value is not None:
                expected[name, t] = value
    assert found.keys() == expected.keys()
    assert all(found[k] == pytest.approx(expected[k], rel=1e-9, abs=1e-9) for k in found)
    one = metrics.increase_at(samples(spark, series), ["s"], str(at(86_400)), 300, extrapolate).collect()
    for r in one:
        assert r.increase == pytest.approx(brute_increase(series[r.s], 86_400, 300, extrapolate))


@pytest.mark.parametrize("chunk_seconds", [7, 100, 10**8])
def test_ordered_scan_equals_a_plain_loop(spark, chunk_seconds):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), at(i), rng.choice([None, i]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v int, i int")
    out = ordered_scan(
        df, ["k"], ["ts"], time_chunk("ts", chunk_seconds),
        last_before={"b": F.col("v")}, last_upto={"u": F.col("v")}, sum_upto={"n": F.col("i").cast("bigint")},
    ).collect()
    got = {r.i: (r.b, r.u, r.n) for r in out}
    last, total = {}, {}
    for k, _, v, i in rows:
        before = last.get(k)
        last[k] = v if v is not None else before
        total[k] = total.get(k, 0) + i
        assert got[i] == (before, last[k], total[k])
    assert len(got) == 300


def test_counter_from_events(spark):
    df = spark.createDataFrame([("a", at(0)), ("a", at(0)), ("a", at(90_000)), ("b", at(1))], "s string, ts timestamp")
    rows = metrics.event_counter(df, ["s"], F.col("ts")).orderBy("s", "ts").collect()
    assert [(r.s, r.value) for r in rows] == [("a", 2.0), ("a", 3.0), ("b", 1.0)]


def test_ratio_drops_absent_sides(spark):
    df = spark.createDataFrame([("x", 500, 1.0), ("x", 200, 3.0), ("y", 200, 2.0)], "r string, code int, v double")
    assert [tuple(r) for r in metrics.ratio_by(df, "v", F.col("code") >= 500, ["r"]).collect()] == [("x", 0.25)]


def quantile(spark, buckets, q):
    df = spark.createDataFrame([(float(le), float(n)) for le, n in buckets], "le double, bucket_count double")
    return metrics.histogram_quantile(df, q).first()[0]


def test_histogram_quantile_rules(spark):
    inf = math.inf
    assert quantile(spark, [(1, 10), (2, 20), (inf, 20)], 0.75) == pytest.approx(1.5)
    assert quantile(spark, [(1, 10), (2, 20), (inf, 20)], 0.25) == pytest.approx(0.5)
    assert quantile(spark, [(1, 10), (2, 10), (inf, 20)], 0.95) == 2.0
    assert quantile(spark, [(-1, 10), (2, 20), (inf, 20)], 0.25) == -1.0
    assert quantile(spark, [(1, 10), (1, 10), (2, 5), (2, 25), (inf, 30)], 0.5) == pytest.approx(0.75)
    assert math.isnan(quantile(spark, [(1, 10), (2, 20)], 0.5))
    assert math.isnan(quantile(spark, [(inf, 20)], 0.5))
    assert math.isnan(quantile(spark, [(1, 0), (inf, 0)], 0.5))


def test_histogram_build(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (3.0,)], "v double")
    assert [tuple(r) for r in metrics.histogram_build(df, "v", [2, 1]).collect()] == [(1.0, 2), (2.0, 2), (math.inf, 3)]


def test_route_templates_fold_names(spark):
    calls = [("GET", "/api/v1/datasets/a"), ("GET", "/api/v1/datasets/b"), ("GET", "/api/v1/datasets/a/versions/banana"),
             ("DELETE", "/api/v1/datasets/a"), ("GET", "/api/v1/datasets/a/"), ("POST", "/api/v1/datasets/a/versions/1/freeze")]
    df = spark.createDataFrame(calls, "m string, p string")
    assert [r[0] for r in df.select(labels.route_template(F.col("m"), F.col("p"))).collect()] == [
        "GET /api/v1/datasets/{name}", "GET /api/v1/datasets/{name}", "GET /api/v1/datasets/{name}/versions/{version}",
        "unmatched", "unmatched", "POST /api/v1/datasets/{name}/versions/{version}/freeze",
    ]


def model_runs(points, hold, gap):
    """(time, active_since, firing) of the true evaluations."""
    out, since, prev = [], None, None
    for t, on in sorted(points):
        if since is not None and gap is not None and t - prev > gap:
            since = None
        if on:
            since = t if since is None else since
            out.append((t, since, t - since >= hold))
        else:
            since = None
        prev = t
    return out


@pytest.mark.parametrize("chunk_seconds", [20, 300, 10**8])
@pytest.mark.parametrize("gap", [None, 40])
def test_runs_equal_sequential_model(spark, chunk_seconds, gap):
    rng = random.Random(chunk_seconds)
    series = {}
    for name in "ab":
        t, points = 0, []
        for _ in range(200):
            t += rng.choice([15, 15, 15, 60])
            points.append((t, rng.random() < 0.85))
        series[name] = points
    df = spark.createDataFrame([(s, at(t), on) for s, ps in series.items() for t, on in ps], "s string, ts timestamp, c boolean")
    found = alerts.sustained_for(df, ["s"], F.col("c"), 60, gap, chunk_seconds).collect()
    seconds = lambda x: int((x - T0).total_seconds())
    for name, points in series.items():
        got = sorted((seconds(r.ts), seconds(r.active_since), r.firing) for r in found if r.s == name)
        assert got == model_runs(points, 60, gap)


def test_threshold_ignores_nan_and_null(spark):
    df = spark.createDataFrame([(0.4,), (0.3,), (math.nan,), (None,)], "v double")
    assert [r.v for r in alerts.threshold_alert(df, "v", ">", 0.3).collect()] == [0.4]


@pytest.mark.parametrize(
    "contender, champion, decision",
    [
        ((99.0, 0.0, 1.0), (500.0, 0.0, 1.0), "HOLD"),
        ((None, 0.0, 1.0), (500.0, 0.0, 1.0), "HOLD"),
        ((100.0, None, 1.0), (500.0, 0.0, 1.0), "HOLD"),
        ((100.0, 0.2, 1.0), (500.0, 0.05, 1.0), "ROLLBACK"),
        ((100.0, 0.1, 1.2), (500.0, 0.05, 1.0), "ROLLBACK"),
        ((100.0, 0.1, 1.05), (500.0, 0.05, 1.0), "PROMOTE"),
        ((100.0, 0.1, None), (500.0, 0.05, 1.0), "PROMOTE"),
        ((100.0, 0.1, math.nan), (500.0, 0.05, 1.0), "PROMOTE"),
    ],
)
def test_promotion_verdict(spark, contender, champion, decision):
    rows = [("s", "contender", *contender), ("s", "champion", *champion)]
    stats = spark.createDataFrame(rows, "service string, role string, requests double, error_rate double, p95 double")
    assert canary.promotion_verdict(stats).first().decision == decision


def test_flawless_contender(spark):
    series = [("s", role, 200, at(t), float(v)) for role in ("champion", "contender") for t, v in [(-600, 0), (-300, 150), (0, 300)]]
    counts = spark.createDataFrame(series, "service string, role string, response_code int, ts timestamp, value double")
    buckets = spark.createDataFrame([], "service string, role string, le double, ts timestamp, value double")
    lenient = canary.promotion_verdict(canary.revision_statistics(counts, buckets, str(T0))).first()
    assert lenient.decision == "PROMOTE" and lenient.contender_error_rate == 0.0
    strict = canary.promotion_verdict(canary.revision_statistics(counts, buckets, str(T0), strict_absent=True)).first()
    assert strict.decision == "HOLD"


def test_psi(spark):
    base = spark.range(1000).selectExpr("cast(id as double) as x", "cast(id % 2 as double) as y")
    same = {r.feature: r for r in drift.psi(base, base, ["x", "y"]).collect()}
    assert same["x"].psi == pytest.approx(0) and not same["x"].drifted and same["y"].psi == pytest.approx(0)
    moved = drift.psi(base, base.selectExpr("x + 500 as x", "y"), ["x", "y"]).collect()
    assert {r.feature: r.drifted for r in moved} == {"x": True, "y": False}
    # Ten equal bins; the moved half puts 0.1 in five of them and 0.5 in the last one.
    share = [0.0001] * 5 + [0.1] * 4 + [0.6]
    assert next(r.psi for r in moved if r.feature == "x") == pytest.approx(sum((a - 0.1) * math.log(a / 0.1) for a in share), abs=1e-6)


def test_quantile_edges_are_exact_with_outliers(spark):
    rng = random.Random(11)
    values = [float(rng.randrange(400)) for _ in range(3000)] + [1e15, -1e15] + [7.0] * 1500
    counts = spark.createDataFrame([("x", v) for v in values], "feature string, v double").groupBy("feature", "v").agg(F.count("*").alias("n"))
    edges = drift.quantile_edges(counts, 10).first()
    ordered = sorted(values)
    assert [edges[f"e{k}"] for k in range(1, 10)] == [ordered[math.ceil(len(values) * k / 10) - 1] for k in range(1, 10)]


@pytest.mark.parametrize("most", [1_000_000, 3])
def test_bracketed_edges_are_exact(spark, most):
    rng = random.Random(12)
    columns = {
        "ties": [float(rng.randrange(40)) for _ in range(6000)] + [1e15, -1e15, float("inf")] + [7.0] * 3000,
        "wide": [rng.lognormvariate(0, 9) * rng.choice([-1, 1]) for _ in range(9003)],
        "same": [2.5] * 9003,
    }
    rows = [*zip(*columns.values()), (None, float("nan"), None)]
    frame = spark.createDataFrame(rows, "ties double, wide double, same double").repartition(3)
    stored = drift.merged_sketches(drift.value_sketches(frame.limit(100), list(columns)).unionByName(drift.value_sketches(frame.subtract(frame.limit(100)), list(columns))))
    for sketches in (None, drift.value_sketches(frame, list(columns), 8)):  # a bad sketch costs passes, not exactness
        found = {r.feature: r for r in drift.bracketed_edges(frame, list(columns), 10, sketches, most).collect()}
        for name, values in columns.items():
            ordered = sorted(values)
            assert [found[name][f"e{k}"] for k in range(1, 10)] == [ordered[math.ceil(len(values) * k / 10) - 1] for k in range(1, 10)]
    assert {r.feature for r in stored.collect()} == set(columns)


def test_psi_from_stored_sketches(spark):
    base = spark.range(3000).selectExpr("cast(id * 7 % 1000 as double) as x", "rand(3) as y").persist()
    parts = drift.value_sketches(base.filter("x < 300"), ["x", "y"]).unionByName(drift.value_sketches(base.filter("x >= 300"), ["x", "y"]))
    actual = base.selectExpr("x + 100 as x", "y * y as y")
    plain, stored = (sorted(map(tuple, drift.psi(base, actual, ["x", "y"], sketches=s).collect())) for s in (None, drift.merged_sketches(parts)))
    assert plain == stored and len(plain) == 2
    assert drift.psi(base.limit(0), actual, ["x"]).count() == 0


def test_label_filter_and_relabel(spark):
    df = spark.createDataFrame([({"job": "a", "code": "503"}, 1), ({"job": "a", "code": "5030"}, 2), ({"code": "500"}, 3)], "l map<string,string>, v int")
    assert [r.v for r in labels.label_filter(df, "l", {"job": "a"}, {"code": "5.."}).collect()] == [1]
    assert [r.v for r in labels.label_filter(df, "l", {"job": ""}).collect()] == [3]
    with pytest.raises(ValueError):
        labels.relabel(df, [labels.Relabel(("v",), action="hash")])


def test_clamp_and_outcome(spark):
    row = spark.range(1).select(
        labels.clamp_min(F.lit(0.0)), labels.clamp_min(F.lit(None).cast("double")),
        labels.outcome_code(F.lit("not_found")), labels.outcome_code(F.lit("disk full")),
    ).first()
    assert list(row) == [0.001, None, 404, 500]
