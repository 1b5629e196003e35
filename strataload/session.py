"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution re-plans joins from measured sizes, splits skewed join
# partitions and merges small ones, so no operator sets a partition count.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("strataload")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
