"""Session settings: a local session for tests and the bench, and settings to start a large job with.

The caller's session is used as it is; nothing in this package changes its settings.
"""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

# What one task takes from a shuffle: small enough to sort in memory next to its neighbours.
TASK_BYTES = 128 * 1024 * 1024


def cluster_settings(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a job whose largest shuffle moves ``shuffle_bytes`` on a cluster with ``cores``.

    Adaptive execution merges small partitions and divides skewed ones, but it never raises the number that
    a shuffle starts with, so that number must fit the largest shuffle and not the default of 200.
    """
    partitions = max(math.ceil(shuffle_bytes / TASK_BYTES), 2 * cores)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": str(2 * TASK_BYTES),
    }


def local_session(name: str, cpus: int = 8, memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
