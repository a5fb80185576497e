"""Session settings and the shared folder used for checkpoints and sinks."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Runtime SQL settings every operator here relies on. Shuffle partition counts
# and partition coalescing are left to the cluster; AQE splits skewed joins.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows with long texts go to Python in batches bounded by bytes, not only by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime settings and let Python workers import this package from any working directory."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    workers = spark.sparkContext.environment
    known = workers.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        workers["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
    return spark


def local_session(cpus: int | str = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gatewright")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        # One partition per core already; merging them further would idle cores.
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = apply_settings(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new path for intermediate data below the cluster's shared checkpoint folder.

    Only a local master may fall back to a folder of this machine; anywhere
    else executors could not see it, so the setting is required. All paths of
    an application lie in one folder, which goes when the application ends.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors share")
        root = os.path.join(tempfile.gettempdir(), "gatewright")
    run = f"{root.rstrip('/')}/gatewright-{spark.sparkContext.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(run)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{run}/{purpose}-{uuid.uuid4().hex}"
