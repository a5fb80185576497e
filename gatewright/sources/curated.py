"""Curated tables and quality reports, one write-once path per version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def curated_path(root: str, dataset: str, version: int) -> str:
    return f"{root.rstrip('/')}/{dataset}/v{version}/data"


def report_path(root: str, dataset: str, version: int) -> str:
    return f"{root.rstrip('/')}/{dataset}/reports/v{version}"


def write_curated(df: DataFrame, root: str, dataset: str, version: int, file_format: str = "parquet", replace: bool = False) -> str:
    """Write a version's rows; an existing version is never overwritten.

    ``replace`` is for a version the catalog has not published: what a run that
    died left behind is replaced.
    """
    path = curated_path(root, dataset, version)
    writer = df.write.mode("overwrite" if replace else "errorifexists").format(file_format)
    if file_format == "csv":
        writer = writer.option("header", "true")
    writer.save(path)
    return path


def read_curated(spark: SparkSession, root: str, dataset: str, version: int, schema=None, file_format: str = "parquet") -> DataFrame:
    """A version's rows. CSV files give text columns unless ``schema`` says otherwise."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if file_format == "csv":
        reader = reader.option("header", "true").option("enforceSchema", "false")
    return reader.format(file_format).load(curated_path(root, dataset, version))


def write_quality_report(results: DataFrame, root: str, dataset: str, version: int, replace: bool = False) -> str:
    """Write suite results (one row per rule of the suite) beside the version; returns the report's path."""
    path = report_path(root, dataset, version)
    results.write.mode("overwrite" if replace else "errorifexists").json(path)
    return path
