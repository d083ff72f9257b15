"""Session helpers: one place for the settings the jobs rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of this package assumes.  AQE re-plans joins and
# shuffle partition counts at runtime and splits skewed join partitions.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only behind a measured size: no static broadcast from file-size
    # estimates; explicit hints are given where a row-count bound was checked,
    # and AQE may still switch a join to broadcast from real shuffle sizes.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "innflow") -> SparkSession:
    """A local session for tests and the bench (no UI, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("INNFLOW_DRIVER_MEMORY", "8g"))
        # small local inputs: let AQE keep one partition per core for CPU-heavy stages
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        # one executor: waiting for a "more local" slot only idles the cores
        .config("spark.locality.wait", "0s")
        # one-file extracts: tasks to spread rows over before the CPU-heavy normalisation
        .config("spark.innflow.localSpread", str(os.cpu_count() if cores == "*" else cores))
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    event_dir = os.environ.get("INNFLOW_EVENT_LOG")
    if event_dir:  # stage/task times for profiling, read from files (no UI)
        builder = (builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
                   .config("spark.eventLog.compress", "false"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session that has none (tests) gets a scratch folder; on a cluster it would be another disk on
    every machine, so there it is an error.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf)
        return conf
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="innflow-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path
