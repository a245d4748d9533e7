"""Numbered versions of a small dataset below one folder."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def versions(spark: SparkSession, path: str, name: str = "version") -> list[int]:
    """Version numbers present as ``<path>/<name>=<n>``, from the file listing alone."""
    try:
        files = spark.read.schema("_none string").parquet(path).inputFiles()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition()):
            return []
        raise
    found = (re.search(rf"/{name}=(\d+)/", file) for file in files)
    return sorted({int(m.group(1)) for m in found if m})
