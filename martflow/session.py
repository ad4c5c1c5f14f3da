"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that a running session takes over at once.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even where an aggregate could have reused the join's partitioning. The extra shuffle is
    # only made when a partition turns out to be skewed.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

BYTES_PER_TASK = 128 * 1024 * 1024


def build_session(app_name: str = "martflow", master: str | None = None, **conf: str) -> SparkSession:
    """Create or reuse a session. Pass extra settings as ``spark__sql__shuffle__partitions="8"``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session built elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, shuffled_bytes: int) -> int:
    """Set the number of shuffle partitions for an amount of data; adaptive execution merges small ones."""
    tasks = max(spark.sparkContext.defaultParallelism, -(-shuffled_bytes // BYTES_PER_TASK))
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    return tasks
