"""Result files: JSON lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_result_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``value, source_file`` of every line below the paths."""
    return spark.read.option("recursiveFileLookup", "true").text(
        [paths] if isinstance(paths, str) else list(paths)
    ).select("value", F.col("_metadata.file_path").alias("source_file"))
