"""Catalog operators on the given tables.

Sources are suppliers, datasets are nations, version requests are orders, and
the action log is read from events: most purchases record ``passed``, signup
and error record ``failed``, view an invalid verdict, a small purchase asks for
a freeze.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewright.operators import catalog
from gatewright.plans.registry import ORACLES, Tables, query
from gatewright.sources.keyed_tables import KeyedTable

SUPPLIER_URI = "'s3://raw/' || s_nationkey::VARCHAR || '/' || s_name"


def supplier_uri() -> Column:
    return F.concat(F.lit("s3://raw/"), F.col("s_nationkey").cast("string"), F.lit("/"), F.col("s_name"))


def sources_table(t: Tables) -> DataFrame:
    """Known sources: every supplier with a positive balance."""
    return t.supplier.filter("s_acctbal > 0").select(
        F.concat(F.lit("src-"), F.col("s_suppkey").cast("string")).alias("id"),
        supplier_uri().alias("uri"),
        F.col("s_nationkey").alias("created_at"),
    )


def datasets_table(t: Tables) -> DataFrame:
    return t.nation.filter("n_nationkey <> 7").select(
        F.col("n_name").alias("name"), F.concat(F.lit("region-"), F.col("n_regionkey").cast("string")).alias("owner")
    )


@query(
    f"""
WITH listed AS (SELECT {SUPPLIER_URI} AS uri, l_orderkey, l_linenumber, l_partkey,
  row_number() OVER (PARTITION BY {SUPPLIER_URI} ORDER BY l_orderkey, l_linenumber, l_partkey) AS rn
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT CASE WHEN s.s_acctbal > 0 THEN 'src-' || s.s_suppkey::VARCHAR ELSE substr(sha256(uri), 1, 24) END AS id,
  uri, l_orderkey, l_linenumber, l_partkey, NOT (s.s_acctbal > 0) AS created
FROM listed JOIN supplier s ON uri = 's3://raw/' || s.s_nationkey::VARCHAR || '/' || s.s_name WHERE rn = 1"""
)
def register_sources(t: Tables) -> DataFrame:
    order = ["l_orderkey", "l_linenumber", "l_partkey"]
    listed = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(supplier_uri().alias("uri"), *order)
    return catalog.register_sources(listed, sources_table(t), order)


STORED_BUCKETS = 8


@query(ORACLES["register_sources"])
def register_sources_stored(t: Tables) -> DataFrame:
    """Against a stored catalog, which stays where it lies."""
    order = ["l_orderkey", "l_linenumber", "l_partkey"]
    listed = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(supplier_uri().alias("uri"), *order)
    stored = KeyedTable.of(sources_table(t), ["uri"], STORED_BUCKETS)
    return catalog.register_sources(listed, stored.rows(), order, STORED_BUCKETS)


@query(
    """
WITH asked AS (SELECT n_name AS name, c_custkey, row_number() OVER (PARTITION BY n_name ORDER BY c_custkey) AS rn
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT name, c_custkey, CASE WHEN rn = 1 AND name NOT IN (SELECT n_name FROM nation WHERE n_nationkey % 2 = 0)
  THEN 'created' ELSE 'conflict' END AS outcome FROM asked"""
)
def create_datasets(t: Tables) -> DataFrame:
    asked = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("name"), "c_custkey")
    existing = t.nation.filter("n_nationkey % 2 = 0").select(F.col("n_name").alias("name"))
    return catalog.create_datasets(asked, existing, ["c_custkey"])


def requests_table(t: Tables) -> DataFrame:
    """One version request per order, for the customer's nation."""
    nations = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    return t.orders.join(nations, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("request_id"), F.col("n_name").alias("dataset"), F.col("o_orderdate").alias("requested_at")
    )


def request_sources(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("request_id"), F.concat(F.lit("src-"), F.col("l_suppkey").cast("string")).alias("source_id")
    )


REQUESTS_SQL = """(SELECT o_orderkey AS request_id, n_name AS dataset, o_orderdate AS requested_at, n_nationkey
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


@query(
    f"""
SELECT request_id, dataset, requested_at,
  CASE WHEN n_nationkey <> 7 AND NOT EXISTS (
    SELECT 1 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_orderkey = request_id AND s_acctbal <= 0)
  THEN 'ok' ELSE 'not_found' END AS outcome
FROM {REQUESTS_SQL}"""
)
def validate_version_refs(t: Tables) -> DataFrame:
    return catalog.validate_version_refs(requests_table(t), request_sources(t), datasets_table(t), sources_table(t))


VERSIONS_SQL = f"""(SELECT dataset, request_id, requested_at,
  (row_number() OVER (PARTITION BY dataset ORDER BY requested_at, request_id) + n_nationkey % 3)::INTEGER AS version
  FROM {REQUESTS_SQL})"""


def held_versions(t: Tables) -> DataFrame:
    """Versions already in the catalog: none, one or two per nation."""
    return t.nation.select(
        F.col("n_name").alias("dataset"), F.explode(F.sequence(F.lit(0), F.col("n_nationkey") % 3)).alias("version")
    ).filter("version > 0")


def numbered(t: Tables) -> DataFrame:
    return catalog.assign_versions(requests_table(t), held_versions(t))


@query(f"SELECT request_id, dataset, requested_at, version FROM {VERSIONS_SQL}")
def assign_versions(t: Tables) -> DataFrame:
    return numbered(t)


@query(
    f"""
WITH refs AS (SELECT request_id, 'src-' || l_suppkey::VARCHAR AS source_id, l_suppkey,
    l_linenumber AS pos
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN (SELECT request_id FROM {REQUESTS_SQL}) ON request_id = o_orderkey),
  good AS (SELECT r.*, s.* FROM refs r JOIN supplier s ON l_suppkey = s_suppkey WHERE s_acctbal > 0)
SELECT v.dataset, v.version, 'region-' || n_regionkey::VARCHAR AS dataset_owner, g.pos, g.source_id,
  CASE WHEN g.source_id IS NOT NULL THEN {SUPPLIER_URI} END AS source_uri
FROM {VERSIONS_SQL} v JOIN nation ON n_name = v.dataset AND n_nationkey <> 7 LEFT JOIN good g ON g.request_id = v.request_id"""
)
def lineage(t: Tables) -> DataFrame:
    versions = numbered(t).select("dataset", "version", "request_id")
    listed = t.lineitem.select(
        F.col("l_orderkey").alias("request_id"),
        F.col("l_linenumber").alias("pos"),
        F.concat(F.lit("src-"), F.col("l_suppkey").cast("string")).alias("source_id"),
    )
    version_sources = versions.join(listed, "request_id").select("dataset", "version", "pos", "source_id")
    found = catalog.lineage(versions, version_sources, datasets_table(t), sources_table(t))
    return found.select("dataset", "version", "dataset_owner", "pos", "source_id", "source_uri")


# ------------------------------------------------------------------- gate --

LOG_SQL = """(SELECT event_id AS seq, ts, 'set-' || (user_id % 5)::VARCHAR AS dataset, user_id::INTEGER AS version, user_id IN (SELECT s_suppkey FROM supplier) AS known,
  CASE WHEN event_type = 'purchase' AND value < 6 THEN 'freeze' ELSE 'quality' END AS action,
  CASE WHEN event_type = 'purchase' AND value < 6 THEN NULL WHEN event_type IN ('error', 'signup') THEN 'failed'
    WHEN event_type = 'view' THEN 'maybe' ELSE 'passed' END AS status
  FROM events WHERE event_type <> 'click')"""

# The catalog already holds some versions frozen, some judged and the rest untouched.
STORED_SQL = """(SELECT s_suppkey::INTEGER AS version, s_suppkey % 7 = 0 AS was_frozen,
  CASE WHEN s_suppkey % 7 < 2 THEN 'passed' WHEN s_suppkey % 7 = 2 THEN 'failed' END AS was FROM supplier)"""

FOLD_SQL = f"""
WITH a AS (SELECT l.*, coalesce(was_frozen, false) AS was_frozen, was, action = 'quality' AND status IN ('passed', 'failed') AS valid
  FROM {LOG_SQL} l LEFT JOIN {STORED_SQL} USING (version)),
p AS (SELECT *, coalesce(last_value(CASE WHEN known AND valid AND NOT was_frozen THEN status END IGNORE NULLS) OVER (
    PARTITION BY dataset, version ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), was) AS prior FROM a),
f AS (SELECT dataset, version, min((ts, seq)) AS first_ok, min(ts) AS frozen_at FROM p
  WHERE known AND action = 'freeze' AND prior = 'passed' GROUP BY ALL),
folded AS (SELECT p.*, f.frozen_at, was_frozen OR coalesce((ts, seq) > first_ok, false) AS after FROM p LEFT JOIN f USING (dataset, version)),
outcomes AS (SELECT *, CASE
  WHEN action = 'quality' AND NOT coalesce(valid, false) THEN 'bad_request'
  WHEN NOT known THEN 'not_found'
  WHEN action = 'quality' THEN CASE WHEN coalesce(after, false) THEN 'frozen' ELSE 'ok' END
  WHEN coalesce(after, false) OR prior = 'passed' THEN 'ok' ELSE 'quality_not_passed' END AS outcome FROM folded)
"""


def action_log(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    freeze = (kind == "purchase") & (F.col("value") < 6)
    return t.events.filter(kind != "click").select(
        F.col("event_id").alias("seq"),
        "ts",
        log_dataset("user_id").alias("dataset"),
        F.col("user_id").cast("int").alias("version"),
        F.when(freeze, "freeze").otherwise("quality").alias("action"),
        F.when(freeze, F.lit(None)).when(kind.isin("error", "signup"), "failed").when(kind == "view", "maybe").otherwise("passed").alias("status"),
    )


def log_dataset(user: str) -> Column:
    return F.concat(F.lit("set-"), (F.col(user) % 5).cast("string"))


def log_versions(t: Tables) -> DataFrame:
    """A version per supplier, with the state that the catalog holds before the log."""
    third, at = F.col("s_suppkey") % 7, lambda day: F.lit(day).cast("timestamp_ntz")
    judged = F.struct(F.when(third < 2, "passed").otherwise("failed").alias("status"), at("2023-12-30").alias("recorded_at"))
    return t.supplier.select(
        log_dataset("s_suppkey").alias("dataset"),
        F.col("s_suppkey").cast("int").alias("version"),
        F.when(third < 3, judged).alias("quality"),
        (third == 0).alias("frozen"),
        F.when(third == 0, at("2023-12-31")).alias("frozen_at"),
    )


@query(f"{FOLD_SQL} SELECT seq, ts, version, status, outcome FROM outcomes WHERE action = 'quality'")
def apply_quality(t: Tables) -> DataFrame:
    return catalog.apply_quality(action_log(t), log_versions(t)).select("seq", "ts", "version", "status", "outcome")


@query(f"{FOLD_SQL} SELECT seq, ts, version, prior AS prior_status, outcome FROM outcomes WHERE action = 'freeze'")
def freeze_gate(t: Tables) -> DataFrame:
    return catalog.freeze_gate(action_log(t), log_versions(t)).select("seq", "ts", "version", "prior_status", "outcome")


STATE_SQL = f"""{FOLD_SQL}, late AS (SELECT version,
  arg_max(status, (ts, seq)) FILTER (action = 'quality' AND outcome = 'ok') AS status,
  arg_max(ts, (ts, seq)) FILTER (action = 'quality' AND outcome = 'ok') AS recorded_at,
  max(frozen_at) FILTER (known) AS frozen_at FROM outcomes GROUP BY 1),
state AS (SELECT version, coalesce(status, was) AS status,
  coalesce(recorded_at, CASE WHEN was IS NOT NULL THEN TIMESTAMP '2023-12-30' END) AS recorded_at,
  was_frozen OR frozen_at IS NOT NULL AS frozen, CASE WHEN was_frozen THEN TIMESTAMP '2023-12-31' ELSE frozen_at END AS frozen_at
  FROM {STORED_SQL} LEFT JOIN late USING (version))"""


def state(t: Tables) -> DataFrame:
    return catalog.catalog_fold(action_log(t), log_versions(t))


@query(f"{STATE_SQL} SELECT version, status, recorded_at, frozen, frozen_at FROM state")
def catalog_fold(t: Tables) -> DataFrame:
    return state(t).select(
        "version", F.col("quality.status").alias("status"), "quality.recorded_at", "frozen", "frozen_at"
    )


@query(f"{STATE_SQL} SELECT version, status FROM state WHERE NOT frozen AND status = 'passed'")
def freezable_versions(t: Tables) -> DataFrame:
    return catalog.freezable_versions(state(t)).select("version", F.col("quality.status").alias("status"))


@query("SELECT n_name AS name, 'region-' || n_regionkey::VARCHAR AS owner FROM nation WHERE n_nationkey <> 7 AND n_name = 'NATION_3'")
def get_dataset(t: Tables) -> DataFrame:
    return catalog.get_dataset(datasets_table(t), "NATION_3")


@query(f"SELECT dataset, version, request_id, requested_at FROM {VERSIONS_SQL} WHERE dataset = 'NATION_3' AND version = 42")
def get_version(t: Tables) -> DataFrame:
    return catalog.get_version(numbered(t), "NATION_3", 42).select("dataset", "version", "request_id", "requested_at")


@query(f"SELECT dataset, version, request_id, requested_at FROM {VERSIONS_SQL} WHERE dataset = 'NATION_3' AND version = 42")
def get_version_stored(t: Tables) -> DataFrame:
    """From versions stored by dataset: one bucket is read, and of that what may hold the version."""
    stored = KeyedTable.of(numbered(t).select("dataset", "version", "request_id", "requested_at"), ["dataset", "version"], STORED_BUCKETS)
    return stored.lookup("NATION_3", 42)


@query(
    f"""SELECT 'src-' || s_suppkey::VARCHAR AS id, {SUPPLIER_URI} AS uri, s_nationkey AS created_at
    FROM supplier WHERE s_acctbal > 0 ORDER BY created_at, id LIMIT 20"""
)
def list_sources(t: Tables) -> DataFrame:
    return catalog.list_sources(sources_table(t), 20)
