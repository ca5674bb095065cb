"""Session helpers for tests, the bench and the query catalogue."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Spark settings the pipeline relies on: AQE re-plans joins on measured sizes
# (a shuffle join becomes a broadcast when the build side turns out small),
# splits skewed join partitions; timestamps are compared in UTC. Applied to the
# sessions this package builds; a caller's own session is never modified.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "slotwise") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SLOTWISE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; set a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is left
    alone; if it is missing there, this fails rather than pick a machine-local
    folder. Local runs (tests, bench) get a fresh temporary folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    path = tempfile.mkdtemp(prefix="slotwise-ckpt-", dir=os.environ.get("SLOTWISE_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    return path
