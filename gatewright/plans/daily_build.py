"""The daily dataset build, end to end.

List the day's objects, register them as sources, read, deduplicate and split,
write a new version, check it, record the verdict and freeze the version when
it passed. Every step is a Spark job; the driver holds only the file listing
and single-row results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gatewright import schemas
from gatewright.functions.dates import capture_interval
from gatewright.functions.positions import with_position
from gatewright.operators import build, catalog, quality
from gatewright.plans.suites import event_suite
from gatewright.sources import curated
from gatewright.sources.catalog_store import load_catalog, save_catalog
from gatewright.sources.events_csv import FILE_ORDER, read_events_csv
from gatewright.sources.objects import discover_objects, objects_path


@dataclass(frozen=True)
class BuildOutcome:
    version: int
    row_count: int
    duplicates_removed: int
    splits: dict[str, int]
    storage_uri: str
    report_uri: str
    failed: list[str]
    frozen: bool


def _append(existing: DataFrame, new: DataFrame) -> DataFrame:
    """New rows in the table's own columns and types; columns they lack are null."""
    known = [F.col(f.name).cast(f.dataType).alias(f.name) for f in existing.schema.fields if f.name in new.columns]
    return existing.unionByName(new.select(*known), allowMissingColumns=True)


def curate(reads: DataFrame) -> DataFrame:
    """First row per natural key, with its split label."""
    first = build.dedup_first(reads, schemas.READ_KEY, FILE_ORDER)
    return build.hash_split(first, "plate").drop("source_block", "source_row")


def build_day(
    spark: SparkSession,
    raw: str,
    day: str,
    root: str,
    dataset: str,
    now: str,
    owner: str = "",
    description: str = "",
    pii: str = "direct",
    retention_days: int = 90,
    git_commit: str = "unknown",
    created_by: str = "daily_build",
    min_rows: int = 1,
    max_rows: int | None = 10_000_000,
) -> BuildOutcome:
    """Build, check and publish one version of ``dataset`` from the objects of ``day``.

    ``now`` is passed in, so a rerun of a past day is reproducible. A version
    that fails its suite stays in the catalog unfrozen, with its report. A run
    that dies publishes nothing; the next one takes the same version number and
    replaces what it left.
    """
    tables = load_catalog(spark, f"{root}/catalog")
    clock = F.lit(now).cast("timestamp")

    objects = discover_objects(spark, raw, day)
    bounds = {n: c.cast("timestamp").alias(n) for n, c in capture_interval(F.col("day")).items()}
    listed = objects.select(
        "uri", F.lit("alpr").alias("kind"), "camera_id", "site", F.col("size").alias("size_bytes"), *bounds.values(), clock.alias("created_at")
    )
    resolved = catalog.register_sources(listed, tables["sources"], ["uri"])
    wanted = spark.createDataFrame(
        [(dataset, description, owner, pii, retention_days)], "name string, description string, owner string, pii string, retention_days int"
    ).withColumn("created_at", clock)
    made = catalog.create_datasets(wanted, tables["datasets"], ["created_at"], ensure=True)

    held = tables["versions"].filter(F.col("dataset") == dataset)
    request = spark.createDataFrame([(dataset, 1)], "dataset string, request_id long").withColumn("requested_at", clock)
    version = catalog.assign_versions(request, held).first().version

    seen = Observation()
    reads = read_events_csv(spark, objects_path(raw, day)).observe(seen, F.count(F.lit(1)).alias("rows"))
    storage_uri = curated.write_curated(curate(reads), f"{root}/curated", dataset, version, replace=True)
    table = curated.read_curated(spark, f"{root}/curated", dataset, version)
    splits = {row.split: row["rows"] for row in build.split_counts(table).collect()}
    content = build.fingerprint(table).first()
    row_count = content.row_count
    duplicates = seen.get["rows"] - row_count

    results = quality.run_suite(table, event_suite(min_rows, max_rows))
    report_uri = curated.write_quality_report(results, f"{root}/curated", dataset, version, replace=True)
    recorded = spark.read.schema(results.schema).json(report_uri)
    verdict = quality.quality_verdict(recorded, report_uri).first()

    created = spark.createDataFrame([(dataset, version, row_count, splits, storage_uri, git_commit, created_by)],
        "dataset string, version int, row_count long, splits map<string,bigint>, storage_uri string, git_commit string, created_by string",
    ).withColumn("created_at", clock)
    versions = _append(spark.createDataFrame([], schemas.VERSIONS), created.withColumn("fingerprint", F.lit(str(content.fingerprint))))
    log = [("quality", 1, verdict.status, report_uri, verdict.failed_checks)]
    if verdict.status == "passed":
        log.append(("freeze", 2, None, None, None))
    steps = spark.createDataFrame(log, "action string, seq bigint, status string, report_uri string, failed_checks array<string>")
    actions = _append(
        spark.createDataFrame([], schemas.ACTIONS), steps.withColumns({"dataset": F.lit(dataset), "version": F.lit(version), "ts": clock})
    )
    # Only this run's actions, on the one version they concern; all other versions stay as they are stored.
    state = catalog.catalog_fold(actions, versions)
    cited = with_position(resolved.select("uri", F.col("id").alias("source_id")), ["uri"]).select(
        F.lit(dataset).alias("dataset"), F.lit(version).alias("version"), F.col("pos").cast("int").alias("pos"), "source_id"
    )
    save_catalog(
        {
            "sources": _append(spark.createDataFrame([], schemas.SOURCES), resolved.filter("created")),
            "datasets": _append(spark.createDataFrame([], schemas.DATASETS), made.filter(F.col("outcome") == "created")),
            "versions": _append(spark.createDataFrame([], schemas.VERSIONS), state),
            "version_sources": _append(spark.createDataFrame([], schemas.VERSION_SOURCES), cited),
            "actions": actions,
        },
        f"{root}/catalog",
    )
    final = catalog.get_version(load_catalog(spark, f"{root}/catalog")["versions"], dataset, version).first()
    return BuildOutcome(
        version, row_count, duplicates, splits, storage_uri, report_uri, list(verdict.failed_checks), final.frozen
    )
