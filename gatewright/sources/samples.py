"""Metric samples as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gatewright import schemas


def samples_stream(
    spark: SparkSession, path: str, schema=schemas.SAMPLES, file_format: str = "parquet", files_per_trigger: int | None = None, **options: str
) -> DataFrame:
    """Stream of sample files as they arrive in a folder."""
    reader = spark.readStream.schema(schema).format(file_format).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)
