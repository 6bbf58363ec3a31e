"""Session settings the operators rely on, and where shared scratch data goes."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def configure(spark: SparkSession) -> SparkSession:
    """Pin the run-time settings results depend on; leave sizing to the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # The JVM never compiles methods above 8000 bytes of bytecode; a feature projection
    # fused into one such method runs interpreted. Let Spark split it instead.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    # Window operators keep a small panel in memory before they spill: at some 90 doubles a
    # row this is about 12 MB for each window of a task.
    spark.conf.set("spark.sql.windowExec.buffer.in.memory.threshold", "16384")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may run without it; then a fresh temporary folder is used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder all executors share"
        )
    made = tempfile.mkdtemp(prefix="loadweave-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, never used path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably (it survives executor loss) and cut its lineage."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Pickle this package by value: stateful operators run wherever their workers start,
    on executors and on the driver, without the package on their path."""
    package = sys.modules[__package__]
    if package.__name__ not in cloudpickle.list_registry_pickle_by_value():
        cloudpickle.register_pickle_by_value(package)
