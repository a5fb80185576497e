"""Dataset build: keep-first deduplication, leak-free split, summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatewright.functions.hashing import split_bucket, split_label

_RANK = "__rank"


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per natural key: the first in ``order``. Null keys equal each other.

    The ``rank = 1`` filter lets Spark keep one row per key in every map task
    before the shuffle, so a key with very many copies stays cheap.
    """
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column absent from one frame is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def hash_split(df: DataFrame, key: str, train: int = 70, val: int = 15, out: str = "split") -> DataFrame:
    """Assign train/val/test by SHA-256 of a key, so one key never lands in two splits."""
    return df.withColumn(out, split_label(split_bucket(F.col(key)), train, val))


def split_counts(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows per split label; rows without a label are left out."""
    return df.filter(F.col(split).isNotNull()).groupBy(split).agg(F.count(F.lit(1)).alias("rows"))


def build_summary(
    raw: DataFrame, keys: Sequence[str], split_key: str, storage_uri: str, train: int = 70, val: int = 15
) -> DataFrame:
    """One row: rows kept, duplicates removed, rows per split.

    The split key is part of the natural key, so counting per key is enough:
    only key columns are read and shuffled, after map-side counting.
    """
    if split_key not in keys:
        raise ValueError("the split key must belong to the natural key")
    per_key = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    label = split_label(split_bucket(F.col(split_key)), train, val)
    totals = per_key.withColumn("split", label).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates_removed"),
        *[F.count_if(F.col("split") == s).alias(s) for s in ("train", "val", "test")],
    )
    # Labels without any row do not appear in the map.
    splits = F.map_filter(
        F.create_map(*[x for s in ("train", "val", "test") for x in (F.lit(s), F.col(s))]), lambda _, n: n > 0
    )
    return totals.select("row_count", "duplicates_removed", splits.alias("splits"), F.lit(storage_uri).alias("storage_uri"))


def source_uris(df: DataFrame, uri: str = "source_uri") -> DataFrame:
    """The distinct source files behind a build, one row each."""
    return df.select(uri).distinct()


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: row count and an order-free content fingerprint."""
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)]).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(row_hash), F.lit(0)).cast("decimal(38,0)").alias("fingerprint"))
