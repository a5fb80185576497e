"""Reading many CSV files by column name."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatewright.functions.numbers import parse_number
from gatewright.session import shared_dir

FILE_ORDER = ("source_uri", "source_block", "source_row")


class NoHeader(ValueError):
    """A file without any line that could be its header."""


def _options(paths: str | Sequence[str]) -> dict[str, str]:
    """A folder is read with all its CSV files at any depth, a list of files as it stands."""
    return {"recursiveFileLookup": "true", "pathGlobFilter": "*.csv"} if isinstance(paths, str) else {}


def header_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``file, header``: the first line of each file that is not blank, read by Spark's own file systems.

    Blank lines before the header are skipped, as the CSV reader does. Files
    without any such line have no row.
    """
    lines = spark.read.options(**_options(paths)).text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
    )
    filled = lines.filter(F.trim(F.regexp_replace("value", "^\ufeff", "")) != "")
    first = filled.groupBy("file").agg(F.min_by("value", "place").alias("header"))
    return first.select("file", F.regexp_replace("header", "^\ufeff|\r$", "").alias("header"))


def layouts_of(spark: SparkSession, paths: str | Sequence[str]) -> tuple[list[tuple[str, ...]], DataFrame]:
    """The header layouts, and a table ``file, layout`` (its place in the list).

    The driver gets one row per layout and the number of files; their names stay in tables.
    """
    path = shared_dir(spark, "csv-headers")
    header_lines(spark, paths).write.parquet(path)
    heads = spark.read.schema("file STRING, header STRING").parquet(path)
    counted = {r.header: r.files for r in heads.groupBy("header").agg(F.count(F.lit(1)).alias("files")).collect()}
    files = spark.read.format("binaryFile").options(**_options(paths)).load(paths if isinstance(paths, str) else sorted(set(paths))).select("path").distinct().count()
    if sum(counted.values()) < files:
        raise NoHeader(f"{files - sum(counted.values())} of {files} files have no header")
    headers = sorted(counted)
    number = F.coalesce(*[F.when(F.col("header") == h, k) for k, h in enumerate(headers)], F.lit(None).cast("int"))
    return [tuple(next(csv.reader([h]))) for h in headers], heads.select(F.col("file").alias("__file"), number.alias("layout"))


def read_events_csv(
    spark: SparkSession, paths: str | Sequence[str], numeric: Sequence[str] = ("confidence",), multiline: bool = False
) -> DataFrame:
    """All files as one table, matched by column name, with the file each row came from.

    ``paths`` is a folder, read with all CSV files below it, or a list of files.
    Files are scanned once, by position. Each row gets the names of its own
    file's header, which is joined to it by file if there are several layouts,
    so a different column order cannot shift values, and a column missing from a
    file is null there. Fields stay text (an empty field is null); ``numeric``
    columns become doubles, null where the text is no number. ``source_block``
    and ``source_row`` give the rows of a file their order. ``multiline`` allows
    line breaks in quoted fields; a file is then one task's work. A file without
    a header is an error.
    """
    if not paths:
        raise ValueError("no files to read")
    layouts, by_file = layouts_of(spark, paths)
    width = max(map(len, layouts), default=0)
    schema = T.StructType([T.StructField(f"_{k}", T.StringType()) for k in range(width)])
    reader = spark.read.schema(schema).options(header="true", enforceSchema="true", multiLine=str(multiline).lower(), **_options(paths))
    rows = reader.csv(paths if isinstance(paths, str) else sorted(set(paths))).select(
        "*",
        F.col("_metadata.file_path").alias("source_uri"),
        F.col("_metadata.file_block_start").alias("source_block"),
        F.monotonically_increasing_id().alias("source_row"),
    )
    if len(layouts) == 1:
        rows = rows.withColumn("layout", F.lit(0))
    else:
        rows = rows.join(by_file, F.col("source_uri") == F.col("__file"))
    columns = list(dict.fromkeys(c for header in layouts for c in header))

    def field(name: str) -> Column:
        places = [(k, header.index(name)) for k, header in enumerate(layouts) if name in header]
        value = F.coalesce(*[F.when(F.col("layout") == k, F.col(f"_{at}")) for k, at in places])
        return F.nullif(value, F.lit(""))

    fields = [(parse_number(field(c)) if c in numeric else field(c)).alias(c) for c in columns]
    return rows.select(*fields, "source_uri", "source_block", "source_row")


def add_source_uri(df: DataFrame, column: str = "source_uri") -> DataFrame:
    """The file behind each row of a file scan."""
    return df.withColumn(column, F.col("_metadata.file_path"))
