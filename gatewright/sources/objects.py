"""Listing of raw objects."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewright.functions.labels import path_parts


class NoObjects(ValueError):
    """The day has no raw objects."""


def objects_path(base: str, day: str, root: str = "alpr") -> str:
    return f"{base.rstrip('/')}/{root}/{day}"


def discover_objects(spark: SparkSession, base: str, day: str, root: str = "alpr", suffix: str = ".csv") -> DataFrame:
    """Objects below ``<base>/<root>/<day>/``: uri, object key, size, modification time, site, camera, day.

    Only the file listing is used; contents are never read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
        .load(objects_path(base, day, root))
        .select(F.col("path").alias("uri"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    )
    if files.isEmpty():
        raise NoObjects(f"no {suffix} objects under {base}/{root}/{day}/")
    key = F.regexp_extract("uri", rf"/({re.escape(root)}/{re.escape(day)}/.*)\z", 1)
    parts = path_parts(key)
    return files.select(
        "uri", key.alias("object"), "size", "modified", parts["site"].alias("site"), parts["camera_id"].alias("camera_id"),
        F.lit(day).alias("day"),
    )
