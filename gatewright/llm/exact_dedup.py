"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch is reduced to one
row per digest (map-side combine, so a text repeated a million times costs a
few rows in the shuffle), the digests already known are removed by a sort-merge
anti-join that reads the index without shuffling it, and the rest is appended.
Only DataFrame functions run; texts are hashed where they are read and never
shuffled for the comparison.

An index is named by its path: opening a path that holds one goes on with it, in
any session, and refuses another number of buckets. Without a path it lies in the
application's own folder and goes with it. A batch that is added again under its
name, after a failure for example, changes nothing and gets the same verdicts.

Defined cases: a null text equals the empty one. Equality ignores the case of
A-Z only. In a batch the row with the largest ``doc_id`` wins, a null
``doc_id`` loses to any other; of rows equal in both, exactly one stays. A text
that an earlier batch brought stays with the earlier winner. An empty batch
adds nothing. A very long text is hashed like any other. Other columns pass
through untouched, whatever their names: they travel in a column of their own.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewright.llm.common import shuffle_width, staged, text_of
from gatewright.session import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
INDEX_SCHEMA = "digest STRING, batch STRING, keep_id BIGINT"


def text_digest(text: Column) -> Column:
    """SHA-256 (lower-case hex) of the text with A-Z lowered, in UTF-8."""
    return F.sha2(F.translate(text, UPPER, UPPER.lower()).cast("binary"), 256)


@dataclass(frozen=True)
class DigestIndex:
    """A bucketed table of the digests seen so far."""

    spark: SparkSession
    name: str
    path: str
    buckets: int

    @classmethod
    def create(cls, spark: SparkSession, name: str | None = None, path: str | None = None, buckets: int | None = None):
        """The index at ``path``, empty if there is none yet. ``buckets`` should give buckets of a few hundred MB at the size it will reach."""
        name = name or f"digest_index_{uuid.uuid4().hex}"
        path = (path or shared_dir(spark, "digest-index")).rstrip("/")
        # A folder whose name begins with an underscore is no part of the table.
        shape = f"{path}/_shape"
        folder = spark._jvm.org.apache.hadoop.fs.Path(shape)
        if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            found = spark.read.schema("buckets INT").json(shape).head().buckets
            if buckets not in (None, found):
                raise ValueError(f"the index at {path} has {found} buckets, not {buckets}")
        else:
            found = buckets or shuffle_width(spark)
            spark.range(1).select(F.lit(found).alias("buckets")).coalesce(1).write.json(shape)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({INDEX_SCHEMA}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {found} BUCKETS LOCATION '{path}'"
        )
        index = cls(spark, name, path, found)
        index.spark.catalog.refreshTable(name)
        return index

    def _append(self, rows: DataFrame) -> None:
        (
            rows.write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .saveAsTable(self.name)
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, batch: DataFrame) -> None:
        """Append the digests of ``batch`` (from :func:`digested`) that the index does not hold yet."""
        fresh = (
            winners(batch)
            .select("digest", "batch", F.col("best.doc_id").alias("keep_id"))
            .repartition(self.buckets, "digest")
            .join(self.table().hint("merge"), "digest", "left_anti")
        )
        self._append(fresh)


def digested(docs: DataFrame, batch: str, columns: list[str] | None = None) -> DataFrame:
    """``docs`` (or ``columns`` of it) as ``doc``, with digest, batch name and a row number, written once so that all three stay fixed."""
    kept = [f"`{c}`" for c in columns or ["doc_id"]]
    out = docs.select(
        F.struct(*kept).alias("doc"), text_digest(text_of()).alias("digest"), F.lit(batch).alias("batch"), F.monotonically_increasing_id().alias("row")
    )
    return staged(out, "digests")


def winners(batch: DataFrame) -> DataFrame:
    """Per digest of the batch: the row that stays (``best``: its id, then its number) and the number of rows."""
    best = F.max(F.struct(F.col("doc.doc_id").alias("doc_id"), "row"))
    return batch.groupBy("digest", "batch").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))


def standing(batch: DataFrame, index: DigestIndex) -> DataFrame:
    """:func:`winners` with what the index says: ``keep_id`` and whether it is the batch's own row (``own``).

    The joins on it meet the hot digests, so the index is read by its path here:
    unbucketed input on both sides leaves AQE free to split a skewed digest.
    """
    plain = index.spark.read.schema(INDEX_SCHEMA).parquet(index.path).withColumnRenamed("batch", "kept_in")
    own = (F.col("batch") == F.col("kept_in")) & F.col("best.doc_id").eqNullSafe(F.col("keep_id"))
    return winners(batch).join(plain, "digest").select("digest", "best", "group_size", "keep_id", own.alias("own"))


def verdicts(batch: DataFrame, index: DigestIndex) -> DataFrame:
    """One row per row of the batch: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``group_size`` counts the rows of this batch with that text.
    """
    return batch.join(standing(batch, index).hint("merge"), "digest").select(
        "doc.doc_id", "keep_id", "group_size", (F.col("own") & (F.col("row") == F.col("best.row"))).alias("kept"), F.col("digest").alias("text_sha256")
    )


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, batch: str = "0") -> DataFrame:
    """Add ``docs`` to ``index`` (a new one by default) and say for every row whether it stays."""
    index = index or DigestIndex.create(docs.sparkSession)
    rows = digested(docs, batch)
    index.add(rows)
    return verdicts(rows, index)


def drop_exact_copies(docs: DataFrame, index: DigestIndex | None = None, batch: str = "0") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    index = index or DigestIndex.create(docs.sparkSession)
    rows = digested(docs, batch, docs.columns)
    index.add(rows)
    own = standing(rows, index).filter("own").select(F.col("best.row").alias("row"))
    return rows.join(own, "row", "left_semi").select("doc.*")
