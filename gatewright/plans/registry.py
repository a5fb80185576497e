"""Registered queries: an operator on the given tables, with the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gatewright.session import apply_settings

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy readers for the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = apply_settings(spark), folder.rstrip("/")

    def for_streams(self) -> Tables:
        """The same tables in a session of its own for stateful streams.

        State is partitioned once for the life of a stream: one partition per core.
        """
        session = self.spark.newSession()
        session.conf.set("spark.sql.shuffle.partitions", str(self.spark.sparkContext.defaultParallelism))
        return Tables(session, self.folder)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function over ``Tables`` under its own name."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if fn.__name__ in QUERIES:
            raise ValueError(f"query {fn.__name__} exists")
        QUERIES[fn.__name__] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register
