"""Running a stream into a parquet folder."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
AVAILABLE_NOW = {"availableNow": True}
AS_THEY_COME = {"processingTime": "0 seconds"}


@contextlib.contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, as keyed state with timers needs it; a query keeps the setting it was started with."""
    before = spark.conf.get(PROVIDER_CONF, None)
    spark.conf.set(PROVIDER_CONF, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER_CONF) if before is None else spark.conf.set(PROVIDER_CONF, before)


def append(stream: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] = AVAILABLE_NOW) -> StreamingQuery:
    """Append a stream to a parquet folder, exactly once per checkpoint."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def drain(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append everything available now."""
    append(stream, path, checkpoint).awaitTermination()
