"""Stored tables that are joined and looked up by a key without being read or moved as a whole.

A table is cut into buckets by one column and sorted by its whole key inside
them, with Bloom filters on the key's columns. New rows that are dealt to the same
buckets meet the stored ones where they lie, and a look-up by key reads one bucket,
and of that only the parts that may hold the key.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewright.session import shared_dir


@dataclass(frozen=True)
class KeyedTable:
    spark: SparkSession
    name: str
    path: str
    key: tuple[str, ...]
    buckets: int

    @classmethod
    def open(cls, spark: SparkSession, schema: str, key: Sequence[str], buckets: int, path: str | None = None, name: str | None = None) -> KeyedTable:
        """The table at ``path``, which may hold one already, written with the same key and number of buckets."""
        name, path = name or f"keyed_{uuid.uuid4().hex}", path or shared_dir(spark, "keyed")
        listed = ", ".join(key)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet CLUSTERED BY ({key[0]}) SORTED BY ({listed}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        spark.catalog.refreshTable(name)
        return cls(spark, name, path, tuple(key), buckets)

    @classmethod
    def of(cls, rows: DataFrame, key: Sequence[str], buckets: int) -> KeyedTable:
        """A new table that holds ``rows``."""
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        table = cls.open(rows.sparkSession, schema, key, buckets)
        table.append(rows)
        return table

    def append(self, rows: DataFrame) -> None:
        writer = self.dealt(rows, self.key[0]).write.mode("append").format("parquet").bucketBy(self.buckets, self.key[0]).sortBy(*self.key)
        for column in self.key:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.option("path", self.path).saveAsTable(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def dealt(self, rows: DataFrame, column: str) -> DataFrame:
        """``rows`` dealt by ``column`` to the table's buckets. It should be distinct there: a bucket is one task."""
        return rows.repartition(self.buckets, column)

    def lookup(self, *values: object) -> DataFrame:
        """The rows with this key, or with these values of its first columns."""
        found = self.rows()
        for column, value in zip(self.key, values):
            found = found.filter(F.col(column) == F.lit(value))
        return found
