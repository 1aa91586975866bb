"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the library relies on. Dates and "now" are UTC; AQE splits
# skewed join partitions even when that costs one more shuffle, because one key
# may hold a large part of all rows.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str = "claimlens", cpus: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and run files that every executor can reach.

    It is the folder named in ``spark.checkpoint.dir`` (or set on the context). Only a
    local-mode session without one gets a temporary folder; a cluster session without one
    is refused, because a machine-local folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if current is None:
            sc.setCheckpointDir(named)
        return named
    if current is not None:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="claimlens-"))
    return sc.getCheckpointDir()


def run_folder(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/claimlens/{name}-{uuid.uuid4().hex}"
