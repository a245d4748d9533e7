"""Session defaults for the jobs in this package."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Fixed session settings every job relies on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


# What one shuffle task should handle: it sorts and spills within an executor's share.
SHUFFLE_TASK_BYTES = 256 * 1024 * 1024
LEAST_SHUFFLE_TASKS = 200


def shuffle_partitions(input_bytes: int) -> int:
    """Shuffle tasks for an input; Spark joins the ones that turn out small."""
    return max(LEAST_SHUFFLE_TASKS, -(-input_bytes // SHUFFLE_TASK_BYTES))


def get_session(
    app: str = "paperweave", master: str | None = None, input_bytes: int | None = None, **extra: str,
) -> SparkSession:
    """Session with the settings above, sized for ``input_bytes`` of input when given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if input_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
    for key, value in {**settings, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
