"""The ``jobs`` and ``batches`` tables as a log of small changes.

A change writes only the rows it changes, as a delta beside the tables, and commits
one log entry that names the deltas of all tables, so they change together and a
write that breaks off is never read. A table is its last base with the deltas
since merged over it, the newest row of each id. Every ``COMPACT_AFTER`` deltas the
merged tables are written as new bases; the entries before the former compaction
go then, so readers keep the files they have begun with for that long.

Rows lie in buckets of their job. An entry lists the buckets it wrote, reads ask
for buckets, and two writers are in conflict where their buckets meet: the one
that commits second does its work again on what the first one left. Adding rows
with new numbers is in conflict with any other such change of the table.

``status_counts`` goes along: per job and status how many batches there are, kept by
signed changes (-1 old, +1 new), which are added up.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from paperweave.operators.order import dense_row_index
from paperweave.operators.state import latest_per_key, require_one, require_valid, split_valid
from paperweave.schemas import STATE_DDL
from paperweave.sources import commits
from paperweave.workspace import remove_folder, stage

BUCKETS = 32
COMPACT_AFTER = 16
COUNTS = "status_counts"
_DDL = {**STATE_DDL, COUNTS: "job_id bigint, status string, n bigint"}
_JOB = {"jobs": "id", "batches": "job_id", COUNTS: "job_id"}


def bucket_of(job: Column) -> Column:
    return F.coalesce(F.pmod(job, F.lit(BUCKETS)), F.lit(0)).cast("int")


class Snapshot(NamedTuple):
    """The tables as a part of the log has them; later commits don't change it."""

    spark: SparkSession
    root: str
    log: dict[int, dict]

    def files(self, table: str) -> tuple[str | None, list[tuple[int, str]]]:
        """The table's base and the deltas over it, with their numbers."""
        mine = [(n, e["tables"][table]) for n, e in sorted(self.log.items()) if table in e["tables"]]
        bases = [(t.get("covers", n), t["data"]) for n, t in mine if t["kind"] == "base"]
        if not bases:
            return None, []
        covers, base = max(bases)
        return base, [(n, t["data"]) for n, t in mine if t["kind"] == "delta" and n > covers]

    def read(self, table: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """The table's rows, or those of some buckets; files are pruned by bucket."""
        base, deltas = self.files(table)
        if base is None:
            raise FileNotFoundError(f"no {table} table in {self.root}")

        # One scan of the base and all deltas; a row's number is that of its folder, the base's 0.
        numbers = {base: 0} | {data: number for number, data in deltas}
        rows = self.spark.read.schema(f"{_DDL[table]}, bucket int").parquet(*[f"{self.root}/{table}/{d}" for d in numbers])
        if buckets is not None:
            rows = rows.filter(F.col("bucket").isin(*buckets))
        if not deltas:
            return rows.drop("bucket")
        if table == COUNTS:
            return rows.groupBy("job_id", "status").agg(F.sum("n").alias("n")).filter("n <> 0")
        folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
        number = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])[folder]
        rows = rows.select(*[c for c in rows.columns if c != "bucket"], number.alias("_number"))
        changes = rows.filter("_number > 0")
        newest = latest_per_key(changes, ["id"], ["_number"]).drop("_number")
        kept = rows.filter("_number = 0").drop("_number").join(newest.select("id"), "id", "left_anti")
        return kept.unionByName(newest.select(*kept.columns))


def snapshot(spark: SparkSession, root: str) -> Snapshot:
    return Snapshot(spark, root, commits.read_log(spark, f"{root}/log"))


def _write(rows: DataFrame, root: str, table: str) -> tuple[str, list[int]]:
    """Write rows under a fresh name; gives it and the buckets they lie in, noted by the pass that writes."""
    spark = rows.sparkSession
    names = spark.createDataFrame([], _DDL[table]).columns
    data, seen = f"data-{uuid.uuid4().hex}", Observation()
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bucket"))
    placed = rows.select(*names, bucket_of(F.col(_JOB[table])).alias("bucket")).observe(seen, F.bit_or(bit).alias("bits"))
    placed.sortWithinPartitions("bucket").write.parquet(f"{root}/{table}/{data}")
    bits = seen.get["bits"] or 0
    return data, [b for b in range(BUCKETS) if bits >> b & 1]


def _touches(entry: dict, other: dict) -> bool:
    for table, mine in entry["tables"].items():
        theirs = other["tables"].get(table)
        if theirs is None or "covers" in theirs or "covers" in mine:  # a compaction changes nothing
            continue
        if "base" in (mine["kind"], theirs["kind"]) or mine.get("numbers") and theirs.get("numbers"):
            return True
        if set(mine["buckets"]) & set(theirs["buckets"]):
            return True
    return False


def change_tables(
    spark: SparkSession, root: str, work: Callable[[Snapshot], Mapping[str, DataFrame]], numbers: str | None = None,
) -> int:
    """Commit the rows that ``work`` makes of the current tables, by table; gives the entry's number.

    Rows replace those with their id; counts are added. Where another writer
    changed the same buckets meanwhile, ``work`` runs again on the new tables.
    ``numbers`` names a table that gets rows with new ids.
    """
    def entry(log: dict[int, dict]) -> dict:
        tables = {}
        for table, rows in work(Snapshot(spark, root, log)).items():
            data, buckets = _write(rows, root, table)
            tables[table] = {"kind": "delta", "data": data, "buckets": buckets, "numbers": table == numbers}
        return {"tables": tables}

    seen = commits.read_log(spark, f"{root}/log")
    number, _ = commits.commit(spark, f"{root}/log", seen, entry, _touches)
    now = snapshot(spark, root)
    if max(len(now.files(table)[1]) for table in _DDL) >= COMPACT_AFTER:
        compact(spark, root)
    return number


def compact(spark: SparkSession, root: str) -> None:
    """Write the merged tables as bases; drop what the former compaction summed up."""
    now = snapshot(spark, root)
    covers = max(now.log)
    tables = {}
    for table in _DDL:
        if now.files(table)[0] is not None:
            rows = now.read(table).repartitionByRange(bucket_of(F.col(_JOB[table])))
            tables[table] = {"kind": "base", "data": _write(rows, root, table)[0], "covers": covers}
    number = covers + 1
    while not commits.try_append(spark, f"{root}/log", number, {"tables": tables}):
        number += 1
    former = max((min(t["covers"] for t in e["tables"].values()) for e in now.log.values()
                  if e["tables"] and all("covers" in t for t in e["tables"].values())), default=0)
    old = [n for n in now.log if n <= former]
    for n in old:
        for table, t in now.log[n]["tables"].items():
            remove_folder(spark, f"{root}/{table}/{t['data']}")
    commits.drop_entries(spark, f"{root}/log", old)


def write_tables(tables: Mapping[str, DataFrame], root: str) -> int:
    """Put whole tables in the place of what is stored, together; counts follow the batches."""
    spark = next(iter(tables.values())).sparkSession
    tables = dict(tables)
    if "batches" in tables:
        tables[COUNTS] = tables["batches"].groupBy("job_id", "status").agg(F.count(F.lit(1)).alias("n"))
    written = {table: {"kind": "base", "data": _write(rows, root, table)[0], "buckets": list(range(BUCKETS))}
               for table, rows in tables.items()}
    seen = commits.read_log(spark, f"{root}/log")
    return commits.commit(spark, f"{root}/log", seen, lambda _: {"tables": written}, lambda *_: False)[0]


def write_state(df: DataFrame, root: str, table: str) -> int:
    """Put a whole table in the place of the stored one."""
    return write_tables({table: df}, root)


def recreate_state(spark: SparkSession, root: str) -> None:
    """All tables, empty."""
    write_tables({table: spark.createDataFrame([], ddl) for table, ddl in STATE_DDL.items()}, root)


def read_state(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The current rows of a table."""
    return snapshot(spark, root).read(table)


def get_job(spark: SparkSession, root: str, job_id: int) -> Row:
    jobs = snapshot(spark, root).read("jobs", [job_id % BUCKETS])
    return require_one(jobs.filter(F.col("id") == job_id), "job")


def create_job(spark: SparkSession, root: str, model: str) -> int:
    """Add a pending job and return its id."""
    made = []

    def work(tables: Snapshot) -> dict[str, DataFrame]:
        made.append((tables.read("jobs").agg(F.max("id")).first()[0] or 0) + 1)
        row = spark.createDataFrame([(made[-1], "pending", model)], "id bigint, status string, model string")
        return {"jobs": row.withColumns({
            "created_at": F.current_timestamp(), "updated_at": F.current_timestamp(),
            "finished_at": F.lit(None).cast("timestamp")}).coalesce(1)}

    change_tables(spark, root, work, numbers="jobs")
    return made[-1]


def create_batches(new: DataFrame, root: str, order: list[str], reject: bool = False) -> DataFrame | None:
    """Add batches with ids after the highest one, in ``order``; absent columns are null.

    A row that breaks a rule of the table, or has no job, is an error. With
    ``reject`` such rows are left out and given back with their rules.
    """
    spark = new.sparkSession
    rejected: list[DataFrame | None] = []

    def work(tables: Snapshot) -> dict[str, DataFrame]:
        old, jobs = tables.read("batches"), tables.read("jobs")
        first = (old.agg(F.max("id")).first()[0] or 0) + 1
        rows = dense_row_index(new, order, "id", first)
        if "status" not in new.columns:
            rows = rows.withColumn("status", F.lit("validating"))
        if "loaded_to_qdrant" not in new.columns:
            rows = rows.withColumn("loaded_to_qdrant", F.lit(0))
        full = spark.createDataFrame([], STATE_DDL["batches"]).unionByName(
            rows.select(*[c for c in rows.columns if c in old.columns]), allowMissingColumns=True)
        if reject:
            full, broken = split_valid(full, jobs)
            rejected.append(broken)
        else:
            require_valid(full, jobs)
            rejected.append(None)
        full = stage(full, "new-batches")
        return {"batches": full, COUNTS: full.groupBy("job_id", "status").agg(F.count(F.lit(1)).alias("n"))}

    change_tables(spark, root, work, numbers="batches")
    return rejected[-1]
