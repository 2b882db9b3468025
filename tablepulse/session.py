"""Session settings and the shared folder for tables that a job writes for itself."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# One shuffle partition should hold about this many bytes, so that the sort
# under a window stays in executor memory.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024


# Without this, adaptive execution leaves a skewed join alone when a grouping
# that follows reuses its partitioning, and one restaurant's rows stay together.
RUNTIME_SETTINGS = {"spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}


def apply_runtime_settings(spark: SparkSession) -> None:
    """Set what the queries rely on and what a running session can still change."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)


def cluster_settings(shuffle_bytes: int, total_cores: int) -> dict[str, str]:
    """Spark settings for a job whose largest shuffle moves ``shuffle_bytes``.

    The partition number is only the starting point: adaptive execution merges
    small partitions, but it cannot split one that is too large for a window,
    so the start is chosen high.
    """
    partitions = max(shuffle_bytes // TARGET_PARTITION_BYTES, total_cores, 1)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **RUNTIME_SETTINGS,
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(2 * TARGET_PARTITION_BYTES),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session, for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tablepulse")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        # Small test data would otherwise end up in one task per write.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16KB")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A new, not yet existing folder that all executors share.

    Below ``spark.checkpoint.dir``, or below the warehouse where that is not set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tablepulse/{uuid.uuid4().hex}"
