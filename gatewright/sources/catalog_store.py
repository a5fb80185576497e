"""Catalog tables on shared storage: snapshot import, atomic publish, load."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewright import schemas
from gatewright.session import shared_dir
from gatewright.sources.json_entries import BrokenDocument, broken_documents, document_entries

_DOCUMENT_VERSION = (
    "STRUCT<dataset: STRING, version: INT, source_ids: ARRAY<STRING>, row_count: BIGINT, splits: MAP<STRING, BIGINT>, "
    "storage_uri: STRING, git_commit: STRING, created_by: STRING, created_at: TIMESTAMP, "
    f"quality: {schemas.QUALITY}, frozen: BOOLEAN, frozen_at: TIMESTAMP>"
)


def _struct(ddl: str) -> str:
    return "STRUCT<" + ", ".join(c.replace(" ", ": ", 1) for c in ddl.split(", ")) + ">"


SNAPSHOT_SCHEMA = (
    f"sources MAP<STRING, {_struct(schemas.SOURCES)}>, datasets MAP<STRING, {_struct(schemas.DATASETS)}>, "
    f"versions MAP<STRING, ARRAY<{_DOCUMENT_VERSION}>>"
)


def empty_catalog(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], ddl) for name, ddl in schemas.CATALOG.items()}


def entries_of(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The parsed values (``v``) of each section, cut from the documents once."""
    broken = broken_documents(spark, path).head(3)
    if broken:
        raise BrokenDocument(f"{', '.join(r.file for r in broken)} cannot be read")
    stored = shared_dir(spark, "snapshot-entries")
    document_entries(spark, path, ["versions"]).write.partitionBy("section").parquet(stored)
    entries = spark.read.schema("file STRING, entry STRING, section STRING").parquet(stored)
    kinds = {"sources": _struct(schemas.SOURCES), "datasets": _struct(schemas.DATASETS), "versions": _DOCUMENT_VERSION}
    return {
        name: entries.filter(F.col("section") == name).select(F.from_json("entry", kind, {"mode": "FAILFAST"}).alias("v")) for name, kind in kinds.items()
    }


def import_catalog_snapshot(spark: SparkSession, path: str, multiline: bool = True) -> dict[str, DataFrame]:
    """Catalog tables from JSON snapshots: one document per file, or one per line.

    A missing path is an empty catalog; unreadable text is an error. A document
    per file may have any size: it is cut into its entries by the tasks that
    read it, so its largest entry is what one task must hold.
    """
    try:
        if multiline:
            listed = entries_of(spark, path)
        else:
            documents = spark.read.schema(SNAPSHOT_SCHEMA).option("mode", "FAILFAST").json(path)
            listed = {name: documents.select(F.explode(name).alias("__k", "v")) for name in ("sources", "datasets", "versions")}
            listed["versions"] = listed["versions"].select(F.explode("v").alias("v"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_catalog(spark)
    sources, datasets, cited = (listed[name].select("v.*") for name in ("sources", "datasets", "versions"))
    versions = cited.drop("source_ids").withColumn("frozen", F.coalesce("frozen", F.lit(False)))
    version_sources = cited.select("dataset", "version", F.posexplode("source_ids").alias("pos", "source_id"))
    actions = spark.createDataFrame([], schemas.ACTIONS)
    return {
        "sources": sources, "datasets": datasets, "versions": versions, "version_sources": version_sources, "actions": actions,
    }


def published_state(spark: SparkSession, root: str) -> int:
    """Number of the newest complete catalog state, 0 when there is none."""
    try:
        marks = spark.read.parquet(f"{root}/published")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return marks.agg(F.max("state")).first()[0] or 0


def save_catalog(changes: Mapping[str, DataFrame], root: str) -> int:
    """Append the rows of one run to their tables, then publish them with one small marker.

    A run writes its own rows only: new sources, citations and actions, and the
    new state of the versions it created or changed. Readers only look at
    published runs, so a job that dies half-way changes nothing for them, and
    its successor takes the same number and replaces its files. One writer at a time.
    """
    spark = next(iter(changes.values())).sparkSession
    state = published_state(spark, root) + 1
    for name in schemas.CATALOG:
        rows = changes.get(name, spark.createDataFrame([], schemas.CATALOG[name]))
        rows.write.mode("overwrite").parquet(f"{root}/{name}/run={state}")
    mark = spark.range(1).select(F.lit(state).alias("state")).coalesce(1)
    mark.write.mode("append").parquet(f"{root}/published")
    return state


def load_catalog(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The published tables, or an empty catalog. Of a version's states, the newest counts."""
    state = published_state(spark, root)
    if state == 0:
        return empty_catalog(spark)
    found = {}
    for name, ddl in schemas.CATALOG.items():
        rows = spark.read.schema(f"{ddl}, run INT").option("basePath", f"{root}/{name}").parquet(f"{root}/{name}")
        found[name] = rows.filter(F.col("run") <= state)
    newest = found["versions"].groupBy("dataset", "version").agg(F.max("run").alias("run"))
    found["versions"] = found["versions"].join(newest, ["dataset", "version", "run"], "left_semi")
    return {name: rows.drop("run") for name, rows in found.items()}
