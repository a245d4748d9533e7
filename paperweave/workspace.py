"""Intermediate tables that outlive a lost executor.

Some operators need a result fixed before they go on (row numbers, bin
states). They write it once as Parquet below the shared folder the session
names in ``spark.checkpoint.dir`` and read it back, which also cuts lineage.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only for local masters."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="paperweave-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/paperweave/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` once to a fresh shared path and return a reader over it."""
    path = new_path(df.sparkSession, label)
    df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the file system that the path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put a finished folder in the place of another one, or where there is none."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (new, path))
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(target, True)
    if not files.rename(source, target):
        raise OSError(f"could not move {new} to {path}")
