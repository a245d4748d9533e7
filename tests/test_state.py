"""State tables: snapshots, roll-ups, constraints."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from paperweave import schemas
from paperweave.operators import state
from paperweave.plans import monitor
from paperweave.sources import state_tables as tables

UTC = dt.timezone.utc


def batches(spark, *rows):
    """Batch rows from dicts; absent columns are null."""
    names = spark.createDataFrame([], schemas.BATCHES_DDL).schema
    base = {"completion_window": "24h", "endpoint": "/e", "object": "batch", "input_file_id": "f",
            "local_file_id": "l", "loaded_to_qdrant": 0, "created_at": dt.datetime(2024, 1, 1)}
    return spark.createDataFrame([tuple({**base, **r}.get(n) for n in names.names) for r in rows], names)


def jobs(spark, *rows):
    return spark.createDataFrame(
        [(i, s, "m", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), None) for i, s in rows], schemas.JOBS_DDL)


def snapshots(spark, *raws):
    return spark.createDataFrame([(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(raws)],
                                 "at bigint, raw string")


@pytest.mark.parametrize("statuses,old,new", [
    (["failed", "in_progress"], "pending", "failed"), (["cancelled"], "pending", "failed"),
    (["finalizing", "completed"], "pending", "processing"), (["completed", "completed"], "pending", "completed"),
    (["expired", "completed"], "processing", "processing"), (["validating"], "pending", "pending"),
    (["validated", "cancelling"], "pending", "pending"), ([], "pending", "pending"),
    (["completed"], "completed", "completed"), (["completed", None], "pending", "pending")])
def test_roll_up(spark, statuses, old, new):
    found = batches(spark, *[{"id": i, "job_id": 1, "status": s} for i, s in enumerate(statuses)])
    now = F.lit("2030-01-01").cast("timestamp")
    row = state.roll_up_jobs(jobs(spark, (1, old)), found, now).first()
    assert row["status"] == new
    assert (row["updated_at"].year == 2030) == (old != new)


def test_expired_can_fail(spark):
    found = batches(spark, {"id": 1, "job_id": 1, "status": "expired"})
    assert state.roll_up_jobs(jobs(spark, (1, "pending")), found, expired_is_failure=True).first()["status"] == "failed"


def test_flatten(spark):
    flat = state.flatten_snapshots(snapshots(
        spark,
        {"id": "b1", "status": "completed", "request_counts": {"completed": 3, "failed": 0, "total": 3},
         "usage": {"total_tokens": 9}, "errors": {"data": [1]}, "created_at": 1704067200, "expired_at": None},
        {"id": "b2", "request_counts": None}, "not json")).orderBy("at").collect()
    one = flat[0]
    assert (one["request_completed"], one["request_failed"], one["request_total"]) == (3, 0, 3)
    assert json.loads(one["usage"]) == {"total_tokens": 9} and json.loads(one["errors"]) == {"data": [1]}
    assert one["created_at"].replace(tzinfo=None) == dt.datetime(2024, 1, 1) and one["expired_at"] is None
    assert {"expired_at", "request_total", "status"} <= set(one["present"]) and "failed_at" not in one["present"]
    assert "request_total" not in flat[1]["present"]
    assert flat[2]["batch_oaid"] is None and flat[2]["present"] == []


def test_partial_update(spark):
    old = batches(
        spark,
        {"id": 1, "job_id": 1, "batch_oaid": "b1", "status": "in_progress", "errors": "old", "request_total": 5,
         "in_progress_at": dt.datetime(2024, 1, 2), "expires_at": dt.datetime(2025, 1, 1)},
        {"id": 2, "job_id": 1, "batch_oaid": "b2", "status": "in_progress"})
    snaps = snapshots(
        spark,
        {"id": "b1", "status": "finalizing"},
        {"id": "b1", "status": "completed", "errors": None, "endpoint": "/new", "completed_at": 1704326400},
        {"id": "ghost", "status": "failed"})
    new_jobs, updated = monitor.refresh(jobs(spark, (1, "pending")), old, snaps, ["at"])
    rows = {r["batch_oaid"]: r for r in updated.collect()}
    assert set(rows) == {"b1", "b2"}
    one = rows["b1"]
    assert one["status"] == "completed" and one["errors"] is None       # present null overwrites
    assert one["request_total"] == 5 and one["endpoint"] == "/e"        # absent or fixed keeps
    assert one["completed_at"].replace(tzinfo=None) == dt.datetime(2024, 1, 4)
    # The last change is read before the update and ignores the planned expiry.
    assert one["calculated_update_at"].replace(tzinfo=None) == dt.datetime(2024, 1, 2)
    assert rows["b2"]["status"] == "in_progress"
    assert new_jobs.first()["status"] == "processing"
    # The same snapshots again change nothing more.
    _, again = monitor.refresh(jobs(spark, (1, "pending")), updated.drop("calculated_update_at"), snaps, ["at"])
    same = [c for c in updated.columns if c != "calculated_update_at"]
    assert sorted(map(str, again.select(same).collect())) == sorted(map(str, updated.select(same).collect()))


def test_last_changed_of_nothing(spark):
    row = batches(spark, {"id": 1, "created_at": None}).select(
        F.date_format(state.last_changed(), "yyyy-MM-dd").alias("d")).first()
    assert row["d"] == "0001-01-01"


def test_latest_of_a_hot_key(spark):
    rows = spark.range(3000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("k"),
                                    F.col("id").alias("at"), F.col("id").cast("string").alias("v"))
    got = {r["k"]: r["v"] for r in state.latest_per_key(rows, ["k"], ["at"]).collect()}
    assert len(got) == 2001 and got[0] == "2997"


def test_violations(spark):
    found = state.state_violations(
        jobs(spark, (1, "pending"), (2, "strange")),
        batches(spark, {"id": 1, "job_id": 1, "batch_oaid": "b", "status": "completed"},
                {"id": 2, "job_id": 9, "batch_oaid": "b", "status": "nope"},
                {"id": 3, "job_id": None, "batch_oaid": None, "status": None}))
    assert sorted((r["table"], r["key"], r["rule"]) for r in found.collect()) == [
        ("batches", "2", "job_id has no parent"), ("batches", "2", "status is unknown"),
        ("batches", "3", "batch_oaid is null"), ("batches", "3", "job_id is null"),
        ("batches", "3", "status is null"), ("jobs", "2", "status is unknown")]


def test_parents_and_gates(spark):
    found = batches(spark, {"id": 1, "job_id": 1}, {"id": 2, "job_id": 2}, {"id": 3, "job_id": 3})
    some = jobs(spark, (1, "completed"), (2, "failed"))
    assert [r["id"] for r in state.of_completed_jobs(found, some).collect()] == [1]
    kept = state.prune_orphans(found, some.select(F.col("id").alias("job_id")), "job_id")
    assert sorted(r["id"] for r in kept.collect()) == [1, 2]
    assert state.batches_of(found, 2).count() == 1
    pairs = state.jobs_with_batches(some, found).select("job_id", "job_status", "id").collect()
    assert sorted(map(tuple, pairs)) == [(1, "completed", 1), (2, "failed", 2)]
    assert state.require_one(found.filter("id = 1"))["id"] == 1
    for bad in ("id = 9", "id > 0"):
        with pytest.raises(LookupError):
            state.require_one(found.filter(bad))


def test_report(spark):
    row = state.status_report(batches(spark, {"id": 1, "batch_oaid": "b", "status": "failed", "errors": ""})
                              .withColumn("calculated_update_at", state.last_changed())).first()
    assert row.asDict() == {"id": "1", "batch_oaid": "b", "status": "failed", "completed": "None",
                            "failed": "None", "total": "None", "errors": "Null",
                            "created": "01/01/2024, 00:00:00", "updated": "01/01/2024, 00:00:00"}


def test_stored_tables(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        tables.read_state(spark, root, "jobs")
    tables.recreate_state(spark, root)
    assert [tables.create_job(spark, root, "m") for _ in range(2)] == [1, 2]
    assert tables.get_job(spark, root, 2)["status"] == "pending"
    with pytest.raises(LookupError):
        tables.get_job(spark, root, 3)
    new = spark.createDataFrame([(2, "b2"), (1, "b1")], "job_id bigint, batch_oaid string").withColumns(
        {c: F.lit("x") for c in ("completion_window", "endpoint", "object", "input_file_id", "local_file_id")})
    new = new.withColumn("created_at", F.current_timestamp())
    tables.create_batches(new, root, ["batch_oaid"])
    stored = tables.read_state(spark, root, "batches").orderBy("id").collect()
    assert [(r["id"], r["batch_oaid"], r["status"], r["loaded_to_qdrant"]) for r in stored] == [
        (1, "b1", "validating", 0), (2, "b2", "validating", 0)]
    assert state.state_violations(tables.read_state(spark, root, "jobs"),
                                  tables.read_state(spark, root, "batches")).count() == 0
    monitor.refresh_stored(spark, root, snapshots(spark, {"id": "b1", "status": "completed"}), ["at"])
    assert tables.get_job(spark, root, 1)["status"] == "completed"
    assert tables.get_job(spark, root, 2)["status"] == "pending"
    tables.recreate_state(spark, root)
    assert tables.read_state(spark, root, "jobs").count() == 0


def test_register_batches(spark, tmp_path):
    root = str(tmp_path)
    tables.recreate_state(spark, root)
    tables.create_job(spark, root, "m")
    made = spark.createDataFrame(
        [(1, f"file-{n}", json.dumps({"id": f"b{n}", "created_at": 1704067200, "input_file_id": f"in{n}",
                                      "endpoint": "/e", "object": "batch", "completion_window": "24h"}))
         for n in (2, 1)], "job_id bigint, local_file_id string, raw string")
    monitor.register_batches(made, root)
    rows = tables.read_state(spark, root, "batches").orderBy("id").collect()
    assert [(r["id"], r["batch_oaid"], r["local_file_id"], r["status"]) for r in rows] == [
        (1, "b1", "file-1", "validating"), (2, "b2", "file-2", "validating")]


def batch_rows(spark, rows):
    """Batches with only (job_id, batch_oaid, status) of their own."""
    return spark.createDataFrame(rows, "job_id bigint, batch_oaid string, status string").withColumns(
        {c: F.lit("x") for c in ("completion_window", "endpoint", "object", "input_file_id", "local_file_id")}
        | {"created_at": F.current_timestamp()})


def test_writes_are_checked(spark, tmp_path):
    root = str(tmp_path)
    tables.recreate_state(spark, root)
    tables.create_job(spark, root, "m")
    bad = batch_rows(spark, [(1, "b1", "completed"), (7, "b2", "completed"), (1, "b3", "shipped")])
    with pytest.raises(ValueError, match="job_id has no parent|status is unknown"):
        tables.create_batches(bad, root, ["batch_oaid"])
    assert tables.read_state(spark, root, "batches").count() == 0
    rejected = tables.create_batches(bad, root, ["batch_oaid"], reject=True)
    assert {r["batch_oaid"]: r["rules"] for r in rejected.collect()} == {
        "b2": ["job_id has no parent"], "b3": ["status is unknown"]}
    assert [r["batch_oaid"] for r in tables.read_state(spark, root, "batches").collect()] == ["b1"]
    for status in ("shipped", None):
        with pytest.raises(ValueError, match="unknown status"):
            monitor.refresh_stored(spark, root, snapshots(spark, {"id": "b1", "status": status}), ["at"])


def test_unfinished_changes_are_not_read(spark, tmp_path):
    root = str(tmp_path)
    tables.recreate_state(spark, root)
    tables.create_job(spark, root, "m")
    # A change that broke off before its commit, with a part of its files there.
    spark.createDataFrame([(9, "failed", 0)], "id bigint, status string, bucket int").write.parquet(f"{root}/jobs/data-lost")
    assert tables.read_state(spark, root, "jobs").count() == 1


def filled(spark, root, jobs=3, each=4):
    tables.recreate_state(spark, root)
    tables.write_state(spark.range(1, jobs + 1).select("id", F.lit("pending").alias("status"), F.lit("m").alias("model"), *[
        F.lit(None).cast("timestamp").alias(c) for c in ("created_at", "updated_at", "finished_at")]), root, "jobs")
    tables.create_batches(batch_rows(spark, [(j, f"b{j}-{n}", "validating") for j in range(1, jobs + 1) for n in range(each)]), root, ["batch_oaid"])


def statuses(spark, root, table="batches", key="batch_oaid"):
    return {r[key]: r["status"] for r in tables.read_state(spark, root, table).collect()}


def counted(spark, root):
    return {(r["job_id"], r["status"]): r["n"] for r in tables.read_state(spark, root, tables.COUNTS).collect()}


def full_counts(spark, root):
    rows = tables.read_state(spark, root, "batches").groupBy("job_id", "status").count().collect()
    return {(r["job_id"], r["status"]): r["count"] for r in rows}


def test_many_small_changes_and_compaction(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "COMPACT_AFTER", 3)
    root = str(tmp_path)
    filled(spark, root)
    want = {f"b{j}-{n}": "validating" for j in (1, 2, 3) for n in range(4)}
    moves = [{"b1-0": "completed"}, {"b1-1": "completed", "b2-0": "failed"}, {"b1-2": "in_progress"},
             {"b1-2": "completed", "b1-3": "completed"}, {"b3-1": "finalizing", "zz": "completed"}, {"b2-0": "completed"}]
    for move in moves:
        monitor.refresh_stored(spark, root, snapshots(spark, *[{"id": k, "status": v} for k, v in move.items()]), ["at"])
        want.update({k: v for k, v in move.items() if k in want})
        assert statuses(spark, root) == want and counted(spark, root) == full_counts(spark, root)
    assert statuses(spark, root, "jobs", "id") == {1: "completed", 2: "failed", 3: "processing"}
    assert len(tables.snapshot(spark, root).files("batches")[1]) < 3
    before = sorted(map(str, tables.read_state(spark, root, "batches").collect()))
    tables.compact(spark, root)
    tables.compact(spark, root)
    assert sorted(map(str, tables.read_state(spark, root, "batches").collect())) == before
    assert counted(spark, root) == full_counts(spark, root)
    assert len(list((tmp_path / "batches").glob("data-*"))) <= 3 and len(tables.snapshot(spark, root).log) <= 3


def test_a_refresh_writes_and_reads_little(spark, tmp_path):
    """k snapshots write k rows; other buckets of jobs and batches are not read."""
    root = str(tmp_path)
    filled(spark, root, jobs=60, each=2)
    monitor.refresh_stored(spark, root, snapshots(spark, {"id": "b7-0", "status": "failed"}, {"id": "b7-1", "status": "completed"}), ["at"])
    now = tables.snapshot(spark, root)
    last = now.log[max(now.log)]["tables"]
    rows = {t: spark.read.parquet(f"{root}/{t}/{last[t]['data']}").count() for t in last}
    assert rows == {"jobs": 1, "batches": 2, "status_counts": 3}
    assert {tuple(last[t]["buckets"]) for t in last} == {(7,)}
    plan = now.read("jobs", [7])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "bucket" in plan[plan.index("PushedFilters"):]


def test_two_writers_of_the_state(spark, tmp_path, monkeypatch):
    """A second refresh commits while the first is under way: on the same job, then on another one."""
    root, inside, plain = str(tmp_path), [], tables.commits.try_append
    filled(spark, root, jobs=2, each=2)
    other = [{"id": "b1-0", "status": "completed"}]

    def later(spark_, folder, number, entry):
        if not inside:
            inside.append(1)
            monitor.refresh_stored(spark, root, snapshots(spark, *other), ["at"])
        return plain(spark_, folder, number, entry)

    monkeypatch.setattr(tables.commits, "try_append", later)
    monitor.refresh_stored(spark, root, snapshots(spark, {"id": "b1-1", "status": "completed"}), ["at"])
    assert statuses(spark, root) == {"b1-0": "completed", "b1-1": "completed", "b2-0": "validating", "b2-1": "validating"}
    assert statuses(spark, root, "jobs", "id") == {1: "completed", 2: "pending"}
    inside.clear()
    other[:] = [{"id": "b2-0", "status": "failed"}]
    monitor.refresh_stored(spark, root, snapshots(spark, {"id": "b1-0", "status": "in_progress"}), ["at"])
    assert statuses(spark, root, "jobs", "id") == {1: "processing", 2: "failed"}
    assert counted(spark, root) == full_counts(spark, root)


def test_two_writers_number_rows(spark, tmp_path, monkeypatch):
    root, inside, plain = str(tmp_path), [], tables.commits.try_append
    tables.recreate_state(spark, root)

    def once(spark_, folder, number, entry):
        if not inside:
            inside.append(None)
            inside[0] = tables.create_job(spark, root, "other")
        return plain(spark_, folder, number, entry)

    monkeypatch.setattr(tables.commits, "try_append", once)
    assert tables.create_job(spark, root, "mine") == 2 and inside == [1]
    assert {r["id"]: r["model"] for r in tables.read_state(spark, root, "jobs").collect()} == {1: "other", 2: "mine"}


def test_expired_fails_stored_jobs_when_asked(spark, tmp_path):
    root = str(tmp_path)
    tables.recreate_state(spark, root)
    tables.create_job(spark, root, "m")
    tables.create_batches(batch_rows(spark, [(1, "b1", "in_progress")]), root, ["batch_oaid"])
    monitor.refresh_stored(spark, root, snapshots(spark, {"id": "b1", "status": "expired"}), ["at"], True)
    assert tables.get_job(spark, root, 1)["status"] == "failed"
