"""Job 4: papers and vectors to the collection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperweave.functions.vectors import of_dimension
from paperweave.operators.collection import collection_points
from paperweave.operators.realign import require_alignment
from paperweave.plans import monitor
from paperweave.sources import collections, state_tables
from paperweave.sources.vectors import read_vectors


def run(vectors: DataFrame, papers: DataFrame, path: str, recreate: bool = False) -> int:
    """Check, join and load; gives the number of points."""
    spark = vectors.sparkSession
    spec = collections.require_collection(spark, path)
    total = require_alignment(vectors, papers)
    checked = of_dimension(F.col("embedding"), spec["dim"], F.col("vec_idx"))
    points = collection_points(vectors.withColumn("embedding", checked), papers)
    # With ``recreate`` the old points stay current until the new ones are written.
    (collections.replace_points if recreate else collections.load_points)(points, path)
    return total


def run_completed(spark: SparkSession, state_root: str, job_id: int, vector_root: str,
                  papers: DataFrame, path: str, recreate: bool = False,
                  snapshots: DataFrame | None = None, order: Sequence[str] = ()) -> int | None:
    """Load only when the job is completed; ``snapshots`` refresh the stored state first."""
    if snapshots is not None:
        monitor.refresh_stored(spark, state_root, snapshots, list(order))
    if state_tables.get_job(spark, state_root, job_id)["status"] != "completed":
        return None
    return run(read_vectors(spark, vector_root, job_id), papers, path, recreate)
