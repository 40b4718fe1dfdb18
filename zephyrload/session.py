"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package is written for. Adaptive execution sizes
# the reduce side, splits skewed join partitions and turns a join into a
# broadcast only once the measured size of a side allows it.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(name: str, cores: str = "8", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "12g")
    )
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    A local session without the setting gets a folder of its own; a cluster
    without it is an error, because a driver-local folder would be lost with
    the driver and is invisible to the executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="zephyrload-"))
        configured = spark.sparkContext.getCheckpointDir()
    return configured.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
