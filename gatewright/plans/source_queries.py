"""Sources and sinks: the given tables written out and read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gatewright.plans.dataset_queries import FIRST_LINES_SQL, first_lines
from gatewright.plans.metric_queries import SAMPLES_SQL, request_samples
from gatewright.plans.quality_queries import LINE_SUITE_SQL, RESULT, line_results
from gatewright.plans.registry import Tables, query
from gatewright.session import shared_dir
from gatewright.sources import catalog_store, curated, events_csv, objects, samples
from gatewright.streaming.sinks import AS_THEY_COME, append, keyed_state


def raw_files(t: Tables) -> str:
    """All events as CSV files in one folder per day and site."""
    base = shared_dir(t.spark, "raw")
    rows = t.events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.col("event_type").alias("site"),
        F.concat(F.lit("0"), F.col("user_id").cast("string")).alias("plate"),
        F.concat(F.lit("cam-"), (F.col("user_id") % 7).cast("string")).alias("camera_id"),
        F.col("ts").cast("string").alias("captured_at"),
        F.col("value").alias("confidence"),
    )
    rows.write.partitionBy("day", "site").option("header", "true").csv(f"{base}/alpr")
    return base


@query(
    """SELECT 'day=2024-01-15' AS day, 'site=' || event_type AS site, true AS filled, true AS named
    FROM events WHERE ts::DATE = DATE '2024-01-15' GROUP BY event_type"""
)
def discover_objects(t: Tables) -> DataFrame:
    """Per site: its objects hold something, and each has the camera and key that its own path says."""
    found = objects.discover_objects(t.spark, raw_files(t), "day=2024-01-15")
    camera = F.regexp_extract("uri", r"([^/]*)\.csv\z", 1)
    key = F.concat(F.lit("alpr/"), "day", F.lit("/"), "site", F.lit("/"), camera, F.lit(".csv"))
    named = (F.col("camera_id") == camera) & (F.col("object") == key) & F.col("uri").endswith(key)
    return found.groupBy("day", "site").agg((F.min("size") > 0).alias("filled"), F.bool_and(named).alias("named"))


READS_SQL = "SELECT '0' || user_id::VARCHAR AS plate, 'cam-' || (user_id % 7)::VARCHAR AS camera_id, value AS confidence"


@query(f"{READS_SQL}, ts AS captured_at FROM events")
def read_events_csv(t: Tables) -> DataFrame:
    reads = events_csv.read_events_csv(t.spark, f"{raw_files(t)}/alpr")
    return reads.select("plate", "camera_id", "confidence", F.col("captured_at").cast("timestamp_ntz").alias("captured_at"))


@query("SELECT event_id, 'events.parquet' AS file FROM events")
def add_source_uri(t: Tables) -> DataFrame:
    return events_csv.add_source_uri(t.events).select("event_id", F.element_at(F.split("source_uri", "/"), -1).alias("file"))


def stored_lines(t: Tables) -> str:
    root = shared_dir(t.spark, "curated")
    curated.write_curated(first_lines(t), root, "lines", 1)
    return root


@query(FIRST_LINES_SQL)
def write_curated(t: Tables) -> DataFrame:
    return t.spark.read.parquet(curated.curated_path(stored_lines(t), "lines", 1))


@query(f"SELECT l_returnflag, count(*)::BIGINT AS n, sum(l_quantity) AS quantity FROM ({FIRST_LINES_SQL}) GROUP BY 1")
def read_curated(t: Tables) -> DataFrame:
    lines = curated.read_curated(t.spark, stored_lines(t), "lines", 1, t.lineitem.schema)
    return lines.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query(LINE_SUITE_SQL)
def write_quality_report(t: Tables) -> DataFrame:
    results = line_results(t)
    path = curated.write_quality_report(results, shared_dir(t.spark, "reports"), "lines", 1)
    return t.spark.read.schema(results.schema).json(path).select(*RESULT)


SNAPSHOT_SQL = """SELECT 'd-' || s_name AS dataset, 'direct' AS pii, 1::INTEGER AS version, s_nationkey::BIGINT AS row_count, 0::INTEGER AS pos,
  's' || s_suppkey::VARCHAR AS source_id, 's3://raw/' || s_name AS uri, s_nationkey > 12 AS frozen FROM supplier"""


def snapshot_files(t: Tables) -> str:
    """One catalog document per supplier: a source, a dataset and a version built from it."""
    path = shared_dir(t.spark, "snapshot")
    source = F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))
    dataset = F.concat(F.lit("d-"), F.col("s_name"))
    document = F.struct(
        F.create_map(source, F.struct(source.alias("id"), F.concat(F.lit("s3://raw/"), "s_name").alias("uri"))).alias("sources"),
        F.create_map(dataset, F.struct(dataset.alias("name"), F.lit("direct").alias("pii"))).alias("datasets"),
        F.create_map(
            dataset,
            F.array(
                F.struct(
                    dataset.alias("dataset"),
                    F.lit(1).alias("version"),
                    F.array(source).alias("source_ids"),
                    F.col("s_nationkey").alias("row_count"),
                    (F.col("s_nationkey") > 12).alias("frozen"),
                )
            ),
        ).alias("versions"),
    )
    t.supplier.select(F.to_json(document)).write.text(path)
    return path


def snapshot_document(t: Tables) -> str:
    """The same catalog as one document: its pieces in order, written to one file."""
    path = shared_dir(t.spark, "document")
    whole = F.from_json("value", catalog_store.SNAPSHOT_SCHEMA)
    lines = t.spark.read.text(snapshot_files(t)).select(whole.alias("d"))
    first = lines.agg(F.min(F.map_keys("d.sources")[0])).head()[0]
    key = F.map_keys("d.sources")[0]
    entry = lambda name: F.concat(F.when(key == first, "").otherwise(","), F.regexp_extract(F.to_json(f"d.{name}"), r"(?s)^\{(.*)\}$", 1))
    names = ("sources", "datasets", "versions")
    pieces = [lines.select(F.lit(2 * k + 1).alias("at"), key.alias("key"), entry(name).alias("value")) for k, name in enumerate(names)]
    marks = [(2 * k, "", ("{" if not k else "},") + f'"{name}":{{') for k, name in enumerate(names)] + [(2 * len(names), "", "}}")]
    rows = t.spark.createDataFrame(marks, "at INT, key STRING, value STRING")
    for piece in pieces:
        rows = rows.union(piece)
    rows.orderBy("at", "key").coalesce(1).select("value").write.text(path)
    return path


@query(SNAPSHOT_SQL)
def import_catalog_document(t: Tables) -> DataFrame:
    """One large document, cut into its entries by the tasks that read it."""
    return joined_catalog(catalog_store.import_catalog_snapshot(t.spark, snapshot_document(t)))


def joined_catalog(tables: dict[str, DataFrame]) -> DataFrame:
    versions = tables["versions"].select("dataset", "version", "row_count", "frozen")
    owners = tables["datasets"].select(F.col("name").alias("dataset"), "pii")
    uris = tables["sources"].select(F.col("id").alias("source_id"), "uri")
    return (
        versions.join(tables["version_sources"], ["dataset", "version"]).join(owners, "dataset").join(uris, "source_id")
        .select("dataset", "pii", "version", "row_count", "pos", "source_id", "uri", "frozen")
    )


@query(SNAPSHOT_SQL)
def import_catalog_snapshot(t: Tables) -> DataFrame:
    return joined_catalog(catalog_store.import_catalog_snapshot(t.spark, snapshot_files(t), multiline=False))


@query(SNAPSHOT_SQL)
def save_catalog(t: Tables) -> DataFrame:
    root = shared_dir(t.spark, "catalog")
    tables = catalog_store.import_catalog_snapshot(t.spark, snapshot_files(t), multiline=False)
    catalog_store.save_catalog(tables, root)
    return joined_catalog(catalog_store.load_catalog(t.spark, root))


ARRIVALS = 4


def in_arrivals(df: DataFrame, number: Column) -> list[str]:
    """``df`` written once, as one folder per arrival: rows of arrival ``number``, those before the first or without a number in the first."""
    path = shared_dir(df.sparkSession, "arrivals")
    arrival = F.least(F.greatest(F.coalesce(number, F.lit(0)), F.lit(0)), F.lit(ARRIVALS - 1)).cast("int")
    df.withColumn("__arrival", arrival).write.partitionBy("__arrival").parquet(path)
    return [f"{path}/__arrival={k}" for k in range(ARRIVALS)]


def run_arrivals(spark: SparkSession, folders: list[str], start: Callable[[str], StreamingQuery]) -> None:
    """Run the query that ``start`` makes of a folder to which one arrival after the other is published, a micro-batch each."""
    source = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark, "published"))
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(source)
    running = start(source.toString())
    try:
        for k, folder in enumerate(folders):
            waiting = spark._jvm.org.apache.hadoop.fs.Path(folder)
            if files.exists(waiting):
                files.rename(waiting, spark._jvm.org.apache.hadoop.fs.Path(source, str(k)))
                running.processAllAvailable()
    finally:
        running.stop()


def out_of_order(row: Column) -> Column:
    """Arrival of a row of January 2024: by time, but up to 40 minutes late at the borders."""
    seen = F.unix_seconds(F.col("ts").cast("timestamp")) + F.pmod(row, F.lit(3)) * 1200
    return F.floor((seen - 1704067200) / (8 * 86400))


def run_samples(t: Tables, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``build`` makes of the request counters as a stream of general samples, some late, read back from its sink."""
    labels = F.create_map(
        F.lit("route"), F.col("route"), F.lit("code"), F.col("code").cast("string"), F.lit("revision"), F.col("revision").cast("string")
    )
    rows = request_samples(t).select(
        F.lit("requests_total").alias("metric"), labels.alias("labels"), F.col("ts").cast("timestamp").alias("ts"), "value"
    )
    out, checkpoint = shared_dir(t.spark, "sink"), shared_dir(t.spark, "checkpoint")
    label = lambda name: F.col("labels")[name]

    def start(path: str) -> StreamingQuery:
        stored = samples.samples_stream(t.spark, path, recursiveFileLookup="true")
        series = stored.select(label("route").alias("route"), label("code").cast("int").alias("code"), label("revision").cast("int").alias("revision"), "ts", "value")
        with keyed_state(t.spark):
            return append(build(series), out, checkpoint, AS_THEY_COME)

    run_arrivals(t.spark, in_arrivals(rows, out_of_order(F.unix_micros("ts"))), start)
    return t.spark.read.parquet(out)


@query(f"SELECT route, code, revision, ts, value FROM {SAMPLES_SQL}")
def samples_stream(t: Tables) -> DataFrame:
    return run_samples(t, lambda stream: stream).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
