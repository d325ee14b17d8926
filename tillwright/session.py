"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. None of them fixes a partition count:
# adaptive execution picks that from the data it sees.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even when the aggregate above then needs its own shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# What one task reads, unless the session says otherwise: rows that pack well take ten times as much memory and more.
TASK_SETTINGS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    for key, value in TASK_SETTINGS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    # listing a table with many date folders takes a few tasks per core, not one per folder
    listing = str(4 * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", listing)
    return spark


# Input bytes (compressed columns) meant for one shuffle partition; adaptive execution merges
# the small ones afterwards.
BYTES_PER_PARTITION = 8 * 2**20


def fit_shuffles(spark: SparkSession, *tables: DataFrame) -> int:
    """Let shuffles start with enough partitions for these inputs; returns their bytes.

    Adaptive execution only merges partitions, so a fixed default would leave hundreds of
    gigabytes in each at large scale. The number is only ever raised.
    """
    total = sum(int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) for df in tables)
    start = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = int(spark.conf.get(start, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    need = -(-total // BYTES_PER_PARTITION)
    if need > now:
        spark.conf.set(start, str(need))
    return total


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder path under the cluster's shared ``spark.checkpoint.dir``; where that is
    unset, under the warehouse. On a cluster a warehouse on the driver's own disk is refused."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        on_disk = base.startswith(("file:", "/"))
        if on_disk and not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    return f"{base.rstrip('/')}/tillwright/{name}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Set one runtime setting for the duration of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
