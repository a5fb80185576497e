"""Metric operators on the given tables.

Requests are events: route = event type, status 500 for errors and 200
otherwise, revision = user parity, latency = value. Counters restart every day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewright.functions import labels
from gatewright.operators import catalog, drift, metrics
from gatewright.plans.catalog_queries import FOLD_SQL, action_log, log_versions
from gatewright.plans.registry import Tables, query

HOUR = 3600
BOUNDS = [1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0]

REQUESTS_SQL = """(SELECT event_id, ts, event_type AS route, CASE WHEN user_id % 2 = 0 THEN 'GET' ELSE 'POST' END AS method,
  CASE event_type WHEN 'error' THEN 500 ELSE 200 END::INTEGER AS code, (user_id % 2)::INTEGER AS revision,
  'svc-' || (user_id % 7)::VARCHAR AS service, CASE WHEN (user_id // 7) % 2 = 0 THEN 'champion' ELSE 'contender' END AS role,
  user_id, value, value::DECIMAL(18, 4) AS seconds FROM events)"""


def requests(t: Tables) -> DataFrame:
    user = F.col("user_id")
    return t.events.select(
        "event_id",
        "ts",
        F.col("event_type").alias("route"),
        F.when(user % 2 == 0, "GET").otherwise("POST").alias("method"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("code"),
        (user % 2).cast("int").alias("revision"),
        F.concat(F.lit("svc-"), (user % 7).cast("string")).alias("service"),
        F.when(F.floor(user / 7) % 2 == 0, "champion").otherwise("contender").alias("role"),
        "user_id",
        "value",
        F.col("value").cast("decimal(18,4)").alias("seconds"),
    )


# ------------------------------------------------------------------ labels --

PATHS = {
    "view": ("GET", "'/api/v1/datasets/d' || user_id::VARCHAR", "GET /api/v1/datasets/{name}"),
    "purchase": (
        "POST",
        "'/api/v1/datasets/d' || user_id::VARCHAR || '/versions/' || event_id::VARCHAR || '/freeze'",
        "POST /api/v1/datasets/{name}/versions/{version}/freeze",
    ),
    "signup": ("PUT", "'/api/v1/datasets/a/versions/' || user_id::VARCHAR || '/quality'", "PUT /api/v1/datasets/{name}/versions/{version}/quality"),
    "click": ("GET", "'/metrics'", "GET /metrics"),
    "error": ("DELETE", "'/api/v1/datasets/d' || user_id::VARCHAR", "unmatched"),
}


@query(
    "SELECT event_id, CASE event_type "
    + " ".join(f"WHEN '{k}' THEN '{label}'" for k, (_, _, label) in PATHS.items())
    + " END AS route FROM events"
)
def route_template(t: Tables) -> DataFrame:
    verb = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, (v, _, _) in PATHS.items()])
    path = F.coalesce(*[F.when(F.col("event_type") == k, F.expr(p.replace("VARCHAR", "STRING"))) for k, (_, p, _) in PATHS.items()])
    return t.events.select("event_id", labels.route_template(verb, path).alias("route"))


@query(
    """SELECT event_id, CASE event_type WHEN 'view' THEN 404 WHEN 'purchase' THEN 409 WHEN 'signup' THEN 200
    WHEN 'click' THEN 409 ELSE 500 END::INTEGER AS code FROM events"""
)
def outcome_code(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    outcome = F.when(kind == "view", "not_found").when(kind == "purchase", "frozen").when(kind == "signup", "ok")
    outcome = outcome.when(kind == "click", "quality_not_passed").otherwise("lost connection")
    return t.events.select("event_id", labels.outcome_code(outcome).alias("code"))


@query(
    "SELECT event_id, value FROM events WHERE event_type = 'view' AND user_id % 4 = 3"
)
def metric_label_filter(t: Tables) -> DataFrame:
    code = (200 + (F.col("user_id") % 4) * 100).cast("string")
    samples = t.events.select(
        "event_id", "value", F.create_map(F.lit("job"), F.col("event_type"), F.lit("status"), code).alias("labels")
    )
    return labels.label_filter(samples, "labels", {"job": "view"}, {"status": "5.."}).select("event_id", "value")


@query(
    """SELECT event_id, 'rack' || user_id % 4 || '-' || user_id % 5 AS place, CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS family,
    'box' || user_id % 5 AS box, event_type AS team, 'box' || user_id % 5 AS host
    FROM events WHERE event_type IN ('click', 'signup')"""
)
def relabel(t: Tables) -> DataFrame:
    user = F.col("user_id")
    targets = t.events.select(
        "event_id",
        F.concat(F.lit("z"), (user % 4).cast("string")).alias("zone"),
        F.concat(F.lit("box"), (user % 5).cast("string")).alias("box"),
        F.when(user % 2 == 0, "even_small").otherwise("odd_large").alias("flavour"),
        F.col("event_type").alias("team"),
    )
    rules = [
        labels.Relabel(("zone", "box"), r"z(\d);box(\d)", target="place", replacement="rack$1-$2"),
        labels.Relabel(("team",), "click|sign.*", "keep"),
        labels.Relabel(("flavour",), "([a-z]+)_.*", target="family"),
        labels.Relabel(("team",), "nobody", target="box", replacement="none"),
        labels.Relabel(("box",), target="host"),
    ]
    return labels.relabel(targets, rules).select("event_id", "place", "family", "box", "team", "host")


@query("SELECT c_custkey, greatest(c_acctbal, 0.001) AS balance FROM customer")
def clamp_min(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", labels.clamp_min(F.col("c_acctbal")).alias("balance"))


@query("SELECT event_id, 'Drift on ' || event_type || ' for model m' || user_id::VARCHAR AS summary, 'warning' AS severity FROM events")
def alert_text(t: Tables) -> DataFrame:
    text = labels.alert_text("Drift on {feature} for model m{model}", feature=F.col("event_type"), model=F.col("user_id"))
    return t.events.select("event_id", text.alias("summary"), F.lit("warning").alias("severity"))


# ----------------------------------------------------------------- roll-up --

ROLLUP_SQL = f"(SELECT method, route, code, count(*)::BIGINT AS requests, sum(seconds)::DOUBLE AS seconds_sum FROM {REQUESTS_SQL} GROUP BY ALL)"


def rollup(t: Tables) -> DataFrame:
    return metrics.request_rollup(requests(t)).withColumn("seconds_sum", F.col("seconds_sum").cast("double"))


@query(f"SELECT * FROM {ROLLUP_SQL}")
def request_rollup(t: Tables) -> DataFrame:
    return rollup(t)


@query(f"SELECT *, row_number() OVER (ORDER BY route, method, code)::BIGINT AS pos FROM {ROLLUP_SQL}")
def exposition_order(t: Tables) -> DataFrame:
    return metrics.exposition_order(rollup(t))


@query(
    f"""
SELECT 'dataset_api_build_info' AS metric, 'version=1.0' AS labels, 1.0::DOUBLE AS value
UNION ALL SELECT 'dataset_api_http_requests_total', 'code=' || code::VARCHAR || ',method=' || method || ',route=' || route, requests::DOUBLE FROM {ROLLUP_SQL}
UNION ALL SELECT 'dataset_api_http_request_duration_seconds_sum', 'code=' || code::VARCHAR || ',method=' || method || ',route=' || route, seconds_sum FROM {ROLLUP_SQL}"""
)
def metric_families(t: Tables) -> DataFrame:
    text = F.array_join(
        F.transform(F.array_sort(F.map_entries("labels")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ","
    )
    return metrics.metric_families(rollup(t), "1.0").withColumn("labels", text)


# ---------------------------------------------------------------- counters --


def counter_sql(source: str, keys: str, amount: str = "count(*)") -> str:
    """Counter samples per minute, restarting daily."""
    return f"""(SELECT {keys}, ts, (sum(n) OVER (PARTITION BY {keys}, day ORDER BY ts))::DOUBLE AS value FROM (
      SELECT {keys}, date_trunc('minute', ts) AS ts, date_trunc('day', ts) AS day, {amount} AS n FROM {source} GROUP BY ALL))"""


def per_minute(t: Tables) -> DataFrame:
    return requests(t).withColumn("ts", F.date_trunc("minute", "ts").cast("timestamp_ntz"))


def count_samples(t: Tables, keys: list[str]) -> DataFrame:
    """Request counters per minute."""
    steps = per_minute(t).groupBy(*keys, "ts").agg(F.count(F.lit(1)).alias("n"))
    return metrics.daily_counter(steps, keys, "n")


SERIES = ["route", "code", "revision"]
SAMPLES_SQL = counter_sql(REQUESTS_SQL, "route, code, revision")


def request_samples(t: Tables) -> DataFrame:
    return count_samples(t, SERIES)


def bucket_source_sql(keys: str) -> str:
    edges = ", ".join(f"{b}::DOUBLE" for b in BOUNDS)
    return f"(SELECT {keys}, le, ts, value FROM {REQUESTS_SQL}, (SELECT unnest([{edges}, 'Infinity'::DOUBLE]) AS le))"


def bucket_counter_sql(keys: str) -> str:
    return counter_sql(bucket_source_sql(keys), f"{keys}, le", "count(*) FILTER (value <= le)")


def bucket_samples(t: Tables, keys: list[str]) -> DataFrame:
    """Latency bucket counters: cumulative counts per bound, per minute."""
    counts = metrics.histogram_build(per_minute(t), "value", BOUNDS, [*keys, "ts"])
    return metrics.daily_counter(counts, [*keys, "le"], "bucket_count")


def grid_increase_sql(samples: str, keys: str, window: int, step: int, extrapolate: bool = True) -> str:
    """Brute force: every sample is listed at every grid time whose window holds it."""
    w, s = window * 1_000_000, step * 1_000_000
    listed = f"""SELECT {keys}, value, epoch_us(ts) AS t,
      unnest(range((epoch_us(ts) + {s - 1}) // {s} * {s}, epoch_us(ts) + {w}, {s})) AS gt FROM {samples}"""
    return window_increase_sql(listed, keys, w, extrapolate)


def sample_increase_sql(samples: str, keys: str, window: int) -> str:
    w = window * 1_000_000
    names = [k.strip() for k in keys.split(",")]
    same = " AND ".join(f"a.{k} = b.{k}" for k in names)
    listed = f"""SELECT {', '.join('a.' + k for k in names)}, b.value, epoch_us(b.ts) AS t, epoch_us(a.ts) AS gt
      FROM {samples} a JOIN {samples} b ON {same} AND epoch_us(b.ts) > epoch_us(a.ts) - {w} AND b.ts <= a.ts"""
    return window_increase_sql(listed, keys, w)


def window_increase_sql(listed: str, keys: str, w: int, extrapolate: bool = True) -> str:
    by = f"{keys}, gt" if keys else "gt"
    lead = f"{keys}, " if keys else ""
    head = f"CASE WHEN ft - (gt - {w}) >= gap * 1.1 THEN gap / 2 ELSE ft - (gt - {w}) END"
    zero = "CASE WHEN raw > 0 AND fv >= 0 THEN (lt - ft) * fv / raw END"
    tail = "CASE WHEN gt - lt >= gap * 1.1 THEN gap / 2 ELSE gt - lt END"
    grown = f"raw * (lt - ft + least({head}, {zero}) + {tail}) / (lt - ft)"
    return f"""(SELECT {lead}make_timestamp(gt) AS ts, {grown if extrapolate else 'raw'} AS increase FROM (
      SELECT {by}, sum(step)::DOUBLE AS raw, min(t) AS ft, max(t) AS lt, arg_min(value, t) AS fv, (max(t) - min(t)) / (count(*) - 1) AS gap FROM (
        SELECT {by}, t, value, CASE WHEN p IS NULL THEN 0 WHEN value < p THEN value ELSE value - p END AS step FROM (
          SELECT *, lag(value) OVER (PARTITION BY {by} ORDER BY t) AS p FROM ({listed})))
      GROUP BY {by} HAVING count(*) >= 2))"""


@query(
    f"""SELECT route, code, revision, ts, value, CASE WHEN value < p THEN value ELSE value - p END AS delta
    FROM (SELECT *, lag(value) OVER (PARTITION BY route, code, revision ORDER BY ts) AS p FROM {SAMPLES_SQL})"""
)
def counter_deltas(t: Tables) -> DataFrame:
    return metrics.counter_deltas(request_samples(t), SERIES)


@query(
    f"SELECT route, code, revision, ts, round(increase / {6 * HOUR} * 1000, 6) AS rate FROM {sample_increase_sql(SAMPLES_SQL, 'route, code, revision', 6 * HOUR)}"
)
def counter_rate(t: Tables) -> DataFrame:
    rates = metrics.counter_rate(request_samples(t), SERIES, 6 * HOUR)
    return rates.withColumn("rate", F.round(F.col("rate") * 1000, 6))


@query(
    f"SELECT route, code, revision, ts, round(increase, 6) AS increase FROM {grid_increase_sql(SAMPLES_SQL, 'route, code, revision', 6 * HOUR, 1800)}"
)
def counter_increase(t: Tables) -> DataFrame:
    grown = metrics.counter_increase(request_samples(t), SERIES, 6 * HOUR, 1800)
    return grown.withColumn("increase", F.round("increase", 6))


GRID = (6 * HOUR, 900)
RATES_SQL = grid_increase_sql(SAMPLES_SQL, "route, code, revision", *GRID)


def ratio_sql(by: str) -> str:
    """Both sides must exist: label sets without any 5xx series give no result."""
    return f"""(SELECT {by}, sum(increase) FILTER (code >= 500) / sum(increase) AS ratio FROM {RATES_SQL}
      GROUP BY {by} HAVING count(*) FILTER (code >= 500) > 0 AND sum(increase) <> 0)"""


@query(f"SELECT ts, round(ratio, 6) AS ratio FROM {ratio_sql('ts')}")
def error_ratio(t: Tables) -> DataFrame:
    ratio = metrics.error_ratio(request_samples(t), SERIES, *GRID)
    return ratio.filter("ratio IS NOT NULL").withColumn("ratio", F.round("ratio", 6))


@query(f"SELECT ts, revision, round(ratio, 6) AS ratio FROM {ratio_sql('ts, revision')}")
def ratio_by(t: Tables) -> DataFrame:
    rates = metrics.counter_rate(request_samples(t), SERIES, GRID[0], step_seconds=GRID[1])
    ratio = metrics.ratio_by(rates, "rate", F.col("code") >= 500, ["ts", "revision"])
    return ratio.filter("ratio IS NOT NULL").withColumn("ratio", F.round("ratio", 6))


# -------------------------------------------------------------- histograms --

HISTOGRAM_SQL = f"""(SELECT user_id, le, count(*) FILTER (value <= le)::BIGINT AS bucket_count
  FROM events, (SELECT unnest([{', '.join(f'{b}::DOUBLE' for b in BOUNDS)}, 'Infinity'::DOUBLE]) AS le) GROUP BY ALL)"""


@query(f"SELECT * FROM {HISTOGRAM_SQL}")
def histogram_build(t: Tables) -> DataFrame:
    return metrics.histogram_build(t.events, "value", BOUNDS, ["user_id"])


def quantile_sql(buckets: str, by: str, value: str, q: float) -> str:
    return f"""(SELECT {by}, CASE WHEN isinf(le) THEN lower ELSE coalesce(lower, 0)
        + (le - coalesce(lower, 0)) * (total * {q * (1 - metrics.RANK_SLACK)!r} - below) / (n - below) END AS quantile FROM (
      SELECT *, lag(le) OVER g AS lower, coalesce(lag(n) OVER g, 0) AS below, max(n) OVER (PARTITION BY {by}) AS total FROM (
        SELECT {by}, le, max(n) OVER (PARTITION BY {by} ORDER BY le) AS n FROM (
          SELECT {by}, le, sum({value}) AS n FROM {buckets} GROUP BY ALL))
      WINDOW g AS (PARTITION BY {by} ORDER BY le))
      WHERE total > 0 AND n >= total * {q * (1 - metrics.RANK_SLACK)!r} AND (below < total * {q * (1 - metrics.RANK_SLACK)!r}))"""


@query(f"SELECT user_id, round(quantile, 6) AS quantile FROM {quantile_sql(HISTOGRAM_SQL, 'user_id', 'bucket_count', 0.95)}")
def histogram_quantile(t: Tables) -> DataFrame:
    buckets = metrics.histogram_build(t.events, "value", BOUNDS, ["user_id"])
    return metrics.histogram_quantile(buckets, 0.95, ["user_id"]).withColumn("quantile", F.round("quantile", 6))


# ----------------------------------------------------------- log counters --


@query(
    f"""{FOLD_SQL} SELECT dataset, ts, count(*) OVER (PARTITION BY dataset ORDER BY ts)::DOUBLE AS value
    FROM outcomes WHERE action = 'quality' AND outcome = 'ok' AND status = 'failed'"""
)
def quality_failures_total(t: Tables) -> DataFrame:
    return metrics.quality_failures_total(catalog.fold_actions(action_log(t), log_versions(t)))


@query(
    f"""{FOLD_SQL} SELECT dataset, ts, count(*) OVER (PARTITION BY dataset ORDER BY ts)::DOUBLE AS value
    FROM outcomes WHERE action = 'freeze' AND outcome = 'quality_not_passed'"""
)
def freeze_rejected_total(t: Tables) -> DataFrame:
    return metrics.freeze_rejected_total(catalog.fold_actions(action_log(t), log_versions(t)))


# ------------------------------------------------------------------- drift --

FEATURES = ["l_quantity", "l_extendedprice"]
CUT = "1998-01-01"


def psi_sql(actual: str, by: str = "") -> str:
    """Stability index with decile edges of the lines shipped before the cut."""
    lead = f"{by}, " if by else ""
    long = "SELECT unnest(['l_quantity', 'l_extendedprice']) AS feature, unnest([l_quantity, l_extendedprice]) AS v"
    return f"""(WITH base AS ({long} FROM lineitem WHERE l_shipdate < TIMESTAMP '{CUT}'),
      seen AS ({long}{', ' + by if by else ''} FROM {actual}),
      cum AS (SELECT feature, v, count(*) OVER (PARTITION BY feature ORDER BY v) AS upto, count(*) OVER (PARTITION BY feature) AS total FROM base),
      edges AS (SELECT feature, min(v) AS edge FROM cum, range(1, 10) AS r(k) WHERE upto * 10 >= total * k GROUP BY feature, k),
      bins AS (SELECT DISTINCT feature, edge FROM edges),
      b AS (SELECT feature, v, (SELECT count(*) FROM bins e WHERE e.feature = base.feature AND e.edge < base.v) AS bin FROM base),
      a AS (SELECT {lead}feature, v, (SELECT count(*) FROM bins e WHERE e.feature = seen.feature AND e.edge < seen.v) AS bin FROM seen),
      slots AS (SELECT {lead}feature, bin FROM (SELECT DISTINCT {lead}feature FROM a), range(0, 10) AS r(bin)),
      bc AS (SELECT feature, bin, count(*) AS n FROM b GROUP BY ALL),
      ac AS (SELECT {lead}feature, bin, count(*) AS n FROM a GROUP BY ALL),
      bt AS (SELECT feature, sum(n) AS t FROM bc GROUP BY 1), att AS (SELECT {lead}feature, sum(n) AS t FROM ac GROUP BY ALL)
      SELECT {lead}feature, sum((pa - pe) * ln(pa / pe)) AS psi FROM (
        SELECT {lead}s.feature, greatest(coalesce(ac.n, 0) / att.t, 0.0001) AS pa, greatest(coalesce(bc.n, 0) / bt.t, 0.0001) AS pe
        FROM slots s LEFT JOIN bc USING (feature, bin) LEFT JOIN ac USING ({lead}feature, bin)
        JOIN bt USING (feature) JOIN att USING ({lead}feature)) GROUP BY ALL)"""


@query(f"SELECT feature, round(psi, 6) AS psi, psi > 0.3 AS drifted FROM {psi_sql(f'''(SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{CUT}')''')}")
def psi(t: Tables) -> DataFrame:
    before = F.col("l_shipdate") < F.lit(CUT).cast("timestamp_ntz")
    found = drift.psi(t.lineitem.filter(before), t.lineitem.filter(~before), FEATURES)
    return found.withColumn("psi", F.round("psi", 6))
