"""Reading the corpus tables and cutting lineage through written tables."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewright.session import apply_settings, shared_dir



def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return apply_settings(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Used where a costly step feeds several branches, or where values that
    depend on the task layout (row numbers) must be fixed once. A lost executor
    then costs one task, not the whole lineage.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text"):
    """The text with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def hash_sample(df: DataFrame, columns: Sequence[str], limit: int) -> DataFrame:
    """About ``limit`` rows of ``df`` (all if it has no more), taken by a hash of ``columns``.

    The rows are counted first and the hash is compared with the share that is
    wanted, a little below the limit. Nothing is sorted and no task sees more
    than its own rows. The same rows give the same sample.
    """
    rows = df.count()
    if rows <= limit:
        return df
    bound = int((0.95 * limit / rows - 0.5) * 2**64)
    return df.filter(F.xxhash64(*columns) < F.lit(bound).cast("bigint"))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tokenizer_file(name: str, folder: str | None = None) -> str:
    """Where a public tokenizer file lies: ``folder``, or the installed package of public tokenizers."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def pick(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the named columns, whatever else the table holds."""
    return df.select(*[F.col(f"`{c}`") for c in columns])
