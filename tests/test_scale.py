"""Plans and task balance that must hold when the data grows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gatewright.functions.chunks import CHUNK, ordered_scan, time_chunk, with_order_chunk
from gatewright.operators import alerts, build, catalog, metrics, quality
from gatewright.plans import all_queries

FOLDER = "/root/testdata/sf0.001"
T0 = datetime(2026, 9, 1)

# Queries whose result needs a stream or files first; their plans are only a read of those.
WITH_ACTIONS = {
    "discover_objects", "read_events_csv", "write_curated", "read_curated", "write_quality_report", "import_catalog_snapshot",
    "save_catalog", "samples_stream", "stream_dedup", "stream_rate_windows", "stream_quality_gate", "stream_alerts",
    "import_catalog_document", "stream_dedup_untimed", "register_sources_stored", "get_version_stored",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(all_queries.QUERIES.keys() - WITH_ACTIONS))
def test_no_pairwise_join_and_no_python(spark, name):
    text = plan(all_queries.QUERIES[name](spark, FOLDER))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert word not in text


@pytest.fixture(scope="module")
def hot(spark):
    """All rows under one key, already partitioned by that key."""
    rows = spark.range(40_000).selectExpr(
        "'a' as s", "1 as version", "'d' as dataset", "id as seq", "timestamp_seconds(1788220800 + id * 15) as ts",
        "cast(id % 1000 as double) as value", "if(id % 3 = 0, 'quality', 'freeze') as action", "if(id % 3 = 0, 'failed', null) as status",
    )
    return rows.repartition("s")


def shares(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes), len(sizes)


@pytest.fixture()
def partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_hot_key_spreads_over_tasks(spark, hot, partitions):
    held = spark.createDataFrame([("d", 1)], "dataset string, version int")
    spread = {
        "scan": ordered_scan(hot, ["s"], ["ts"], time_chunk("ts", 3600), sum_upto={"n": F.col("value")}),
        "increase": metrics.counter_increase(hot, ["s"], 300),
        "runs": alerts.sustained_for(hot, ["s"], F.col("value") > 10, 60, chunk_seconds=3600),
        "fold": catalog.fold_actions(hot.drop("s", "value"), held, chunk_seconds=3600),
    }
    for name, df in spread.items():
        largest, used = shares(df)
        assert used == 8 and largest < 0.3, name


def test_dedup_of_one_hot_key_sends_few_rows(spark, hot):
    text = plan(build.dedup_first(hot.sparkSession.range(1000).selectExpr("id % 3 as k", "id as o"), ["k"], ["o"]))
    # The partial limit sits below the exchange.
    assert text.index("Exchange hashpartitioning") < text.rindex("WindowGroupLimit")


def test_suite_reads_only_its_columns(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    text = plan(quality.run_suite(lines, [quality.between("l_quantity", 1, 5), quality.unique("l_orderkey")]))
    assert text.count("FileScan") == 1 and "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text


def test_grid_increase_has_one_shuffle_of_samples(spark, tmp_path):
    spark.range(10).selectExpr("'a' as s", "timestamp_seconds(id) as ts", "1.0D as value").write.parquet(str(tmp_path / "s"))
    text = plan(metrics.counter_increase(spark.read.parquet(str(tmp_path / "s")), ["s"], 300, 15))
    assert text.count("Exchange hashpartitioning") == 1


def test_bursts_of_one_instant_are_split(spark):
    burst = spark.range(20_000).selectExpr(
        "'d' as dataset", "1 as version", "id as seq", "id as request_id", "timestamp_seconds(1788220800) as ts", "timestamp_seconds(1788220800) as requested_at",
        "if(id % 3 = 0, 'quality', 'freeze') as action", "if(id % 3 = 0, 'failed', null) as status",
    )
    rows = with_order_chunk(burst, ["dataset", "version"], "ts", "seq", 86_400, burst_rows=1_000)
    sizes = [r["count"] for r in rows.groupBy(CHUNK).count().collect()]
    assert len(sizes) >= 16 and max(sizes) < 2_500
    versions = spark.createDataFrame([("d", 1)], "dataset string, version int")
    folded = catalog.fold_actions(burst, versions, burst_rows=1_000)
    assert {r.outcome: r["count"] for r in folded.groupBy("outcome").count().collect()} == {"ok": 6_667, "quality_not_passed": 13_333}
    numbered = catalog.assign_versions(burst.select("dataset", "request_id", "requested_at"), versions, burst_rows=1_000)
    assert numbered.filter("version <> request_id + 2").isEmpty() and numbered.count() == 20_000
