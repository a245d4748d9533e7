"""One status refresh: snapshots into batches, batches into jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperweave.operators import state
from paperweave.sources.state_tables import COUNTS, Snapshot, bucket_of, change_tables, create_batches
from paperweave.workspace import stage


def refresh(
    jobs: DataFrame, batches: DataFrame, snapshots: DataFrame, order: list[str],
    now: Column | None = None, expired_is_failure: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Jobs and batches after ``snapshots`` (a ``raw`` column plus ``order`` columns).

    Of several snapshots of a batch the last in ``order`` counts.
    """
    flat = state.flatten_snapshots(snapshots)
    latest = state.latest_per_key(flat, ["batch_oaid"], order)
    updated = state.update_batches(batches, latest)
    return state.roll_up_jobs(jobs, updated, now, expired_is_failure), updated


def refresh_stored(
    spark: SparkSession, root: str, snapshots: DataFrame, order: list[str], expired_is_failure: bool = False,
) -> DataFrame:
    """Apply snapshots to the stored tables in one commit; gives the batches they name with their last-changed time.

    Only buckets with such batches are read, and only rows that the snapshots name
    are written. A job is rolled up from its counts per status, which change by -1
    and +1 with its batches. A snapshot that sets no or an unknown status is an
    error and changes nothing.
    """
    flat = state.flatten_snapshots(snapshots)
    state.require_known_status(flat)
    latest = stage(state.latest_per_key(flat, ["batch_oaid"], order), "snapshots")
    done: list[DataFrame] = []

    def work(tables: Snapshot) -> dict[str, DataFrame]:
        named = tables.read("batches").select("job_id", "batch_oaid").join(latest.select("batch_oaid"), "batch_oaid", "left_semi")
        buckets = [r[0] for r in named.select(bucket_of(F.col("job_id"))).distinct().collect()]
        before = tables.read("batches", buckets).join(latest.select("batch_oaid"), "batch_oaid", "left_semi")
        after = stage(state.update_batches(before.withColumn("_before", F.col("status")), latest), "refresh")
        changes = state.status_changes(after, "_before")
        touched = after.select("job_id").distinct()
        counts = tables.read(COUNTS, buckets).join(touched, "job_id", "left_semi").unionByName(changes).groupBy(
            "job_id", "status").agg(F.sum("n").alias("n"))
        asked = counts.groupBy(F.col("job_id").alias("id")).agg(
            state.counted_status(expired_is_failure=expired_is_failure).alias("_asked"))
        done.append(after.drop("_before"))
        return {"batches": after, COUNTS: changes, "jobs": state.moved_jobs(tables.read("jobs", buckets), asked)}

    change_tables(spark, root, work)
    return done[-1]


def register_batches(created: DataFrame, root: str, reject: bool = False) -> DataFrame | None:
    """Store newly created batches.

    ``created`` has the service's answer as ``raw`` and the columns ``job_id``
    and ``local_file_id``; batches get their ids in the order of the files.
    Rows that break rules are an error, or are given back with ``reject``.
    """
    flat = state.flatten_snapshots(created).drop("present")
    status = F.coalesce(F.col("status"), F.lit("validating"))
    return create_batches(flat.withColumn("status", status), root, ["job_id", "local_file_id"], reject)
