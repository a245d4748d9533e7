"""Job and batch state: snapshots in, statuses out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from paperweave.functions import naming
from paperweave.schemas import (
    BATCH_STATUSES, BATCH_TIMES, CHANGE_TIMES, JOB_STATUSES, REQUIRED, SNAPSHOT_DDL, UPDATABLE,
)

# Result of 'last changed' when a batch has no time at all.
NO_TIME = "0001-01-01 00:00:00"


# --- lookups ----------------------------------------------------------------

def require_one(df: DataFrame, what: str = "row") -> Row:
    """The only row of a key lookup; none or several is an error."""
    rows = df.take(2)
    if len(rows) != 1:
        raise LookupError(f"expected exactly one {what}, found {'none' if not rows else 'several'}")
    return rows[0]


def batches_of(batches: DataFrame, job_id: int) -> DataFrame:
    return batches.filter(F.col("job_id") == job_id)


def jobs_with_batches(jobs: DataFrame, batches: DataFrame) -> DataFrame:
    """Every batch with its job's columns prefixed by ``job_``."""
    parent = jobs.select(*[F.col(c).alias("job_id" if c == "id" else f"job_{c}") for c in jobs.columns])
    return parent.join(batches, "job_id")


def of_completed_jobs(batches: DataFrame, jobs: DataFrame) -> DataFrame:
    """Batches whose job is completed."""
    done = jobs.filter(F.col("status") == "completed").select(F.col("id").alias("job_id"))
    return batches.join(done, "job_id", "left_semi")


def prune_orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose parent still exists."""
    return children.join(parents.select(key), key, "left_semi")


# --- snapshots --------------------------------------------------------------

def flatten_snapshots(snapshots: DataFrame, raw: str = "raw") -> DataFrame:
    """Service snapshots (JSON text) as batch columns.

    ``id`` becomes ``batch_oaid``, request counts become ``request_*``, unix
    seconds become times. ``present`` lists the batch columns the snapshot sets:
    a key that is present counts even with a null value, and request counts only
    when they are there.
    """
    kept = [F.col(c) for c in snapshots.columns if c != raw]
    s = F.col("_s")
    counts = ["completed", "failed", "total"]
    # Malformed text has no keys; a null list must not reach the concat below.
    keys = F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))
    count_names = F.when(
        s["request_counts"].isNotNull(), F.array(*[F.lit(f"request_{c}") for c in counts])
    ).otherwise(F.array().cast("array<string>"))
    plain = ["completion_window", "endpoint", "object", "status", "input_file_id",
             "output_file_id", "error_file_id", "usage", "errors"]
    return snapshots.withColumn("_s", F.from_json(raw, SNAPSHOT_DDL)).select(
        *kept,
        s["id"].alias("batch_oaid"),
        *[s[c].alias(c) for c in plain],
        *[s["request_counts"][c].alias(f"request_{c}") for c in counts],
        *[naming.unix_time(s[c]).alias(c) for c in BATCH_TIMES],
        F.concat(keys, count_names).alias("present"),
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key in ``order``; keys may have any number of rows.

    ``max_by`` combines inside each map task, so only one row per key and task
    is shuffled.
    """
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")


def last_changed(times: Sequence[str] = CHANGE_TIMES, kind: str = "timestamp") -> Column:
    """Latest of several times, nulls ignored; the minimum date when all are null."""
    least = F.lit(NO_TIME).cast(kind)
    return F.greatest(*[F.coalesce(F.col(c), least) for c in times])


def partial_upsert(
    old: DataFrame, new: DataFrame, key: str, columns: Sequence[str], present: str = "present",
) -> DataFrame:
    """Overwrite the columns a change sets, nulls included, and keep the others.

    ``new`` has at most one row per key and a list ``present`` of the columns it
    sets. Keys only in ``new`` are ignored.
    """
    prefix = "_new_"
    change = new.select(
        F.col(key), F.col(present).alias("_present"),
        *[F.col(c).alias(prefix + c) for c in columns])

    def merged(name: str) -> Column:
        if name not in columns:
            return F.col(name)
        is_set = F.coalesce(F.array_contains("_present", name), F.lit(False))
        return F.when(is_set, F.col(prefix + name)).otherwise(F.col(name)).alias(name)

    return old.join(change, key, "left").select(*[merged(c) for c in old.columns])


def update_batches(batches: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Stored batches after their latest snapshots, plus ``calculated_update_at``.

    That time comes from the stored row as it was before the update.
    """
    before = batches.withColumn("calculated_update_at", last_changed())
    return partial_upsert(before, snapshots, "batch_oaid", UPDATABLE)


# --- statuses ---------------------------------------------------------------

def rolled_status(status: str = "status", expired_is_failure: bool = False, counts: Column | None = None) -> Column:
    """Aggregate: the job status a group of batch statuses asks for, or null.

    Any failed or cancelled batch fails the job; else any running batch means
    processing; else all completed means completed; else nothing changes. Rows
    for which ``counts`` is false are passed over.
    """
    failing = ["cancelled", "failed"] + (["expired"] if expired_is_failure else [])
    column = F.col(status)
    done = F.coalesce(column == "completed", F.lit(False))
    if counts is not None:
        # A null in an aggregate of conditions is passed over.
        column, done = F.when(counts, column), F.when(counts, done)
    return (
        F.when(F.bool_or(column.isin(failing)), "failed")
        .when(F.bool_or(column.isin("in_progress", "finalizing")), "processing")
        .when(F.bool_and(done), "completed"))


def counted_status(status: str = "status", n: str = "n", expired_is_failure: bool = False) -> Column:
    """Aggregate: ``rolled_status`` from how many batches have each status; none of it counts where ``n`` is 0."""
    return rolled_status(status, expired_is_failure, F.col(n) > 0)


def status_changes(batches: DataFrame, before: str) -> DataFrame:
    """(job_id, status, n): how the counts change when batches go from the status in column ``before`` to their own."""
    signed = F.array(F.struct(F.col(before).alias("status"), F.lit(-1).cast("bigint").alias("n")),
                     F.struct("status", F.lit(1).cast("bigint").alias("n")))
    return batches.select("job_id", F.inline(signed)).groupBy("job_id", "status").agg(F.sum("n").alias("n")).filter("n <> 0")


def moved_jobs(jobs: DataFrame, asked: DataFrame, now: Column | None = None) -> DataFrame:
    """The rows of ``jobs`` whose status changes to the one in ``asked`` (id, _asked), after the change."""
    moved = jobs.join(asked, "id").filter(F.col("_asked").isNotNull() & ~F.col("_asked").eqNullSafe(F.col("status")))
    now = F.current_timestamp() if now is None else now
    changed = {"status": F.col("_asked"), "updated_at": now}
    return moved.select(*[changed.get(c, F.col(c)).alias(c) for c in jobs.columns])


def roll_up_jobs(
    jobs: DataFrame, batches: DataFrame, now: Column | None = None, expired_is_failure: bool = False,
) -> DataFrame:
    """Jobs with the status their batches ask for.

    ``updated_at`` changes only together with the status; a job without batches
    stays as it is.
    """
    asked = batches.groupBy(F.col("job_id").alias("id")).agg(
        rolled_status(expired_is_failure=expired_is_failure).alias("_asked"))
    moved = F.col("_asked").isNotNull() & ~F.col("_asked").eqNullSafe(F.col("status"))
    now = F.current_timestamp() if now is None else now
    changed = {"status": F.when(moved, F.col("_asked")).otherwise(F.col("status")),
               "updated_at": F.when(moved, now).otherwise(F.col("updated_at"))}
    return jobs.join(asked, "id", "left").select(
        *[changed.get(c, F.col(c)).alias(c) for c in jobs.columns])


def status_report(batches: DataFrame) -> DataFrame:
    """Display rows: texts for counts, errors and times."""
    count = {c: F.coalesce(F.col(f"request_{c}").cast("string"), F.lit("None"))
             for c in ("completed", "failed", "total")}
    return batches.select(
        F.col("id").cast("string").alias("id"), "batch_oaid", "status",
        *[column.alias(name) for name, column in count.items()],
        naming.or_null_word(F.col("errors")).alias("errors"),
        naming.display_time(F.col("created_at")).alias("created"),
        naming.display_time(F.col("calculated_update_at")).alias("updated"))


def job_header(jobs: DataFrame) -> DataFrame:
    return jobs.select("id", F.upper("status").alias("job_status"))


# --- constraints ------------------------------------------------------------

def rule_violations(df: DataFrame, table: str, key: str, rules: Mapping[str, Column]) -> DataFrame:
    """``table, key, rule`` for every row that breaks a rule, in one scan.

    A rule is the condition that must hold; a null outcome does not break it.
    """
    broken = F.array_compact(F.array(*[F.when(~cond, F.lit(name)) for name, cond in rules.items()]))
    return df.select(
        F.lit(table).alias("table"), F.col(key).cast("string").alias("key"),
        F.explode(broken).alias("rule"))


def missing_parents(children: DataFrame, table: str, key: str, foreign: str,
                    parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-null foreign key has no parent row."""
    known = parents.select(F.col(parent_key).alias(foreign))
    return (children.filter(F.col(foreign).isNotNull()).join(known, foreign, "left_anti")
            .select(F.lit(table).alias("table"), F.col(key).cast("string").alias("key"),
                    F.lit(f"{foreign} has no parent").alias("rule")))


def required_rules(columns: Sequence[str]) -> dict[str, Column]:
    return {f"{c} is null": F.col(c).isNotNull() for c in columns}


def state_violations(jobs: DataFrame, batches: DataFrame) -> DataFrame:
    """Enum, not-null and foreign-key violations of both state tables."""
    def rules(table: str, statuses: Sequence[str]) -> dict[str, Column]:
        return {**required_rules(REQUIRED[table]), "status is unknown": F.col("status").isin(*statuses)}

    return (
        rule_violations(jobs, "jobs", "id", rules("jobs", JOB_STATUSES))
        .unionByName(rule_violations(batches, "batches", "id", rules("batches", BATCH_STATUSES)))
        .unionByName(missing_parents(batches, "batches", "id", "job_id", jobs, "id")))


def batch_violations(batches: DataFrame, jobs: DataFrame) -> DataFrame:
    """Violations of new batches against their own rules and the stored jobs."""
    return state_violations(jobs.limit(0), batches).filter("rule <> 'job_id has no parent'").unionByName(
        missing_parents(batches, "batches", "id", "job_id", jobs, "id"))


def split_valid(batches: DataFrame, jobs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rows that break rules with the list of ``rules``)."""
    broken = batch_violations(batches, jobs).groupBy(F.col("key").cast("bigint").alias("id")).agg(
        F.array_sort(F.collect_set("rule")).alias("rules"))
    return batches.join(broken, "id", "left_anti"), batches.join(broken, "id")


def require_valid(batches: DataFrame, jobs: DataFrame) -> None:
    """An error that names some of the rows that break rules."""
    broken = batch_violations(batches, jobs).take(5)
    if broken:
        raise ValueError("batches break rules: " + "; ".join(f"{r['key']}: {r['rule']}" for r in broken))


def require_known_status(snapshots: DataFrame) -> None:
    """An error for flattened snapshots that would store no or an unknown status."""
    sets = F.array_contains("present", "status")
    odd = snapshots.filter(sets & ~F.coalesce(F.col("status").isin(*BATCH_STATUSES), F.lit(False)))
    found = odd.select("batch_oaid", "status").take(5)
    if found:
        raise ValueError("unknown status: " + "; ".join(f"{r['batch_oaid']}: {r['status']}" for r in found))
