"""Vector datasets, one per job, in row order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperweave.functions.vectors import of_dimension
from paperweave.sources.versions import versions
from paperweave.workspace import replace_folder


def _job_folder(root: str, job_id: int) -> str:
    return f"{root.rstrip('/')}/job_id={job_id}"


def write_vectors(vectors: DataFrame, root: str, job_id: int, dim: int, version: int = 1) -> str:
    """Write ``vec_idx, embedding`` as float32, ranged and sorted by ``vec_idx``.

    A vector without ``dim`` values fails the write. A second run is written
    beside the version and replaces it as a whole once it is complete.
    """
    folder = f"{_job_folder(root, job_id)}/version={version}"
    beside = f"{_job_folder(root, job_id)}/_writing-{version}"  # readers skip such names
    (
        vectors.select("vec_idx", F.col("embedding").cast("array<float>").alias("embedding"))
        .repartitionByRange("vec_idx").sortWithinPartitions("vec_idx")
        .withColumn("embedding", of_dimension(F.col("embedding"), dim, F.col("vec_idx")))
        .write.mode("overwrite").option("compression", "zstd").parquet(beside)
    )
    replace_folder(vectors.sparkSession, beside, folder)
    return folder


def read_vectors(spark: SparkSession, root: str, job_id: int) -> DataFrame:
    """The job's only vector dataset; none or several is an error."""
    folder = _job_folder(root, job_id)
    found = versions(spark, folder)
    if not found:
        raise FileNotFoundError(f"no vectors in {folder}")
    if len(found) > 1:
        raise ValueError(f"several vector datasets in {folder}: versions {found}")
    return spark.read.parquet(f"{folder}/version={found[0]}")
