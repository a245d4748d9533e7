"""Job 3: result files to the job's vectors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperweave import schemas
from paperweave.operators import realign
from paperweave.plans import monitor
from paperweave.sources import landing, state_tables
from paperweave.sources.lines import read_result_lines
from paperweave.sources.vectors import write_vectors
from paperweave.workspace import stage


@dataclass(frozen=True)
class Collected:
    vectors: DataFrame     # vec_idx, embedding
    rejects: DataFrame     # lines that could not be used
    unmatched: DataFrame   # requests and answers that do not fit each other


def run(
    spark: SparkSession, result_paths: str | Sequence[str] | DataFrame, manifest: DataFrame, vector_root: str,
    job_id: int, dim: int, data_path: str = "response.data",
) -> Collected:
    """Parse, align and store; results are paths or lines (``value, source_file``)."""
    lines = result_paths if isinstance(result_paths, DataFrame) else read_result_lines(spark, result_paths)
    parsed = realign.parse_lines(lines, data_path)
    # Parsed vectors take a third of their JSON; parsing once pays for the write.
    parsed = stage(parsed.withColumn("value", F.when(~F.col("is_good"), F.col("value"))), "results")
    good = realign.good_lines(parsed)
    folder = write_vectors(realign.align_vectors(good, manifest), vector_root, job_id, dim)
    return Collected(spark.read.parquet(folder), realign.rejected_lines(parsed), realign.unmatched_requests(good, manifest))


def run_completed(
    spark: SparkSession, state_root: str, job_id: int, result_paths: str | Sequence[str],
    manifest: DataFrame, vector_root: str, snapshots: DataFrame | None = None, order: Sequence[str] = (),
) -> Collected | None:
    """Collect only when the job is completed; the model comes from the job.

    Of the files below ``result_paths``, when it is one folder, those that belong to
    the job's stored batches are read. ``snapshots`` of the service, in ``order``,
    refresh the stored state first.
    """
    if snapshots is not None:
        monitor.refresh_stored(spark, state_root, snapshots, list(order))
    job = state_tables.get_job(spark, state_root, job_id)
    if job["status"] != "completed":
        return None
    if isinstance(result_paths, str):
        batches = state_tables.read_state(spark, state_root, "batches").filter(F.col("job_id") == job_id)
        missing = landing.missing_results(spark, batches, result_paths).take(5)
        if missing:
            raise FileNotFoundError("no result files " + ", ".join(r["result_name"] for r in missing))
        result_paths = landing.result_lines(spark, batches, result_paths)
    return run(spark, result_paths, manifest, vector_root, job_id, schemas.model_dimension(job["model"]))
