"""Quality gate on micro-batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gatewright.operators.quality import Expectation, run_suite
from gatewright.streaming.sinks import AVAILABLE_NOW


def stream_quality_gate(stream: DataFrame, suite: Sequence[Expectation], root: str, checkpoint: str, trigger: Mapping[str, object] = AVAILABLE_NOW) -> StreamingQuery:
    """Run the suite on every micro-batch and file its rows under the verdict.

    ``<root>/rows`` is one table partitioned by ``place`` (``curated`` when the
    suite passed, ``quarantine`` when not) and ``batch``; the report of a batch
    stands in ``<root>/reports``. A batch overwrites its own folders, so one
    repeated after a failure leaves the same result.
    """

    def judge(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            results = run_suite(batch, suite).withColumn("batch_id", F.lit(batch_id))
            report = f"{root}/reports/{batch_id}"
            results.coalesce(1).write.mode("overwrite").json(report)
            failed = results.sparkSession.read.schema("success boolean").json(report).filter(~F.col("success"))
            place = "curated" if failed.isEmpty() else "quarantine"
            batch.write.mode("overwrite").parquet(f"{root}/rows/place={place}/batch={batch_id}")
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(judge)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
