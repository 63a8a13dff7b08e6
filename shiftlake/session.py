"""Spark session settings the job relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings results depend on: naive timestamps are interpreted in UTC so that
# truncation and date casts agree with the SQL oracle; ANSI mode stays on and
# every parse uses the ``try_`` forms.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cores: int = 8, shuffle_partitions: int = 8, app: str = "shiftlake", driver_memory: str = "8g"
) -> SparkSession:
    """A local session for tests and the benchmark (the UI server stays off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment; only when it is unset (local
    tests) a folder of our own is created and registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="shiftlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    return f"{checkpoint_root(spark)}/shiftlake/{name}-{uuid.uuid4().hex[:12]}"
