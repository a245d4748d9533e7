"""Vector collections: a specification, loads of points and what is current of them.

Points lie in buckets of ids. A load writes the whole new content of the buckets
it touches under a name of its own and then commits an entry that lists them.
Current is, for every bucket, the last entry that lists it. Other buckets are not
rewritten, a load that breaks off leaves no trace, and points sent again replace
themselves, also from a new stream or checkpoint. The entry also has the rows and the
smallest and largest id of each file, so a range of ids is read from few files.

Several writers may load at once: a load that finds, when it commits, that others
changed buckets of its own merges again with what they left; loads into other
buckets go through untouched. A generation of points becomes current as a whole,
by its entry in the specification's log.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from paperweave.operators.collection import prepare_vectors
from paperweave.operators.dedup import keep_first
from paperweave.schemas import UPLOAD_BATCH_ROWS
from paperweave.sources import commits
from paperweave.workspace import remove_folder, stage

BUCKET_IDS = 1_000_000  # ids of a bucket


def collection_spec(spark: SparkSession, path: str) -> dict | None:
    """Dimension, metric, current generation and bucket size; None where there is no collection."""
    log = commits.read_log(spark, f"{path}/spec")
    return {**log[max(log)], "generation": max(log)} if log else None


def _new_generation(spark: SparkSession, path: str, after: int, spec: dict) -> None:
    if not commits.try_append(spark, f"{path}/spec", after + 1, spec):
        raise commits.Conflict(f"another writer made a new generation of {path}")


def create_collection(
    spark: SparkSession, path: str, dim: int, metric: str = "cosine", recreate: bool = False,
    bucket_ids: int = BUCKET_IDS,
) -> None:
    """A new, empty collection; an existing one is an error unless ``recreate``."""
    if metric != "cosine":
        raise ValueError(f"unknown metric {metric!r}")
    old = collection_spec(spark, path)
    if old is not None and not recreate:
        raise FileExistsError(f"collection {path} exists")
    _new_generation(spark, path, old["generation"] if old else 0,
                    {"dim": dim, "metric": metric, "quantisation": "binary", "bucket_ids": bucket_ids})


def empty_collection(spark: SparkSession, path: str) -> None:
    """Recreate a collection with the dimension it has."""
    spec = require_collection(spark, path)
    create_collection(spark, path, spec["dim"], spec["metric"], True, spec["bucket_ids"])


def require_collection(spark: SparkSession, path: str) -> dict:
    spec = collection_spec(spark, path)
    if spec is None:
        raise FileNotFoundError(f"no collection at {path}")
    return spec


def _folders(path: str, generation: int) -> tuple[str, str]:
    return f"{path}/points/generation={generation}", f"{path}/loads/generation={generation}"


def _current(log: dict[int, dict]) -> dict[int, str]:
    """The load that has each bucket's points."""
    current: dict[int, str] = {}
    for number in sorted(log):
        entry = log[number]
        current.update(dict(entry["current"]) if "current" in entry else dict.fromkeys(entry["buckets"], entry["load"]))
    return current


def _stored(spark: SparkSession, data: str, log: dict[int, dict], only: set[int] | None = None) -> DataFrame | None:
    """Current points with their bucket; only folders of the loads that have them are listed."""
    current = {b: load for b, load in _current(log).items() if only is None or b in only}
    if not current:
        return None
    loads = sorted(set(current.values()))
    pairs = spark.createDataFrame(list(current.items()), "bucket bigint, load string")
    stored = spark.read.option("basePath", data).parquet(*[f"{data}/load={load}" for load in loads]).withColumn(
        "bucket", F.col("bucket").cast("bigint")).withColumn("load", F.col("load").cast("string"))
    if only is not None:
        stored = stored.filter(F.col("bucket").isin(sorted(only)) if len(only) < 1000 else F.col("bucket").between(min(only), max(only)))
    # One row per bucket of a million ids: small enough to broadcast whatever the collection.
    return stored.join(F.broadcast(pairs), ["load", "bucket"]).drop("load")


def _files(log: dict[int, dict]) -> list[list]:
    """``[load, bucket, file, rows, least id, largest id]`` of the files with current points."""
    current = _current(log)
    listed = {(f[0], f[1], f[2]): f for number in sorted(log) for f in log[number]["files"]}
    return [f for f in listed.values() if current.get(f[1]) == f[0]]


def _written(spark: SparkSession, data: str, load: str) -> list[list]:
    """The same of the files that a load wrote: a row per file, from a scan of the ids alone."""
    written = spark.read.option("basePath", data).parquet(f"{data}/load={load}")
    return [[load, *r] for r in written.groupBy(
        F.col("bucket").cast("bigint"), F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)), F.min("point_id"), F.max("point_id")).orderBy("bucket", "file").collect()]


def read_points(spark: SparkSession, path: str) -> DataFrame | None:
    """Current points, None while there were no loads."""
    data, loads = _folders(path, require_collection(spark, path)["generation"])
    stored = _stored(spark, data, commits.read_log(spark, loads))
    return None if stored is None else stored.drop("bucket")


def read_range(spark: SparkSession, path: str, start: int, end: int) -> DataFrame | None:
    """Current points with ``start <= id < end``, None while there were no loads.

    The log names the files that can hold them; no other is listed or opened.
    """
    data, loads = _folders(path, require_collection(spark, path)["generation"])
    files = _files(commits.read_log(spark, loads))
    if not files:
        return None
    chosen = [f for f in files if f[4] < end and f[5] >= start]
    # With none in the range one file gives the columns, and its points are filtered away.
    names = [f"{data}/load={load}/bucket={bucket}/{name}" for load, bucket, name, *_ in chosen or files[:1]]
    return points_in_range(spark.read.parquet(*names), start, end)


def point_count(spark: SparkSession, path: str) -> int:
    """Number of current points, from the log alone."""
    _, loads = _folders(path, require_collection(spark, path)["generation"])
    return sum(f[3] for f in _files(commits.read_log(spark, loads)))


def _load(points: DataFrame, path: str, generation: int, bucket_ids: int, order: Sequence[str]) -> None:
    spark = points.sparkSession
    data, loads = _folders(path, generation)
    bucket = F.call_function("div", F.col("point_id"), F.lit(bucket_ids))
    names = [c for c in points.columns if c not in order]
    arrived = F.struct(*order, F.monotonically_increasing_id().alias("_position"))
    new = stage(points.select(*names, bucket.alias("bucket"), arrived.alias("_arrived")), "points")
    # One number per bucket of a million ids, not per row.
    touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]
    seen = commits.read_log(spark, loads)
    # Of one id sent twice in a load the last counts; the order is fixed before a second try.
    rows = keep_first(new, ["bucket", "point_id"], [F.desc("_arrived")], [*names, "bucket"])

    def work(log: dict[int, dict]) -> dict:
        load = f"{max(log, default=0) + 1:08d}-{uuid.uuid4().hex[:12]}"
        merged = rows.withColumn("_age", F.lit(0))
        old = _stored(spark, data, log, set(touched))
        if old is not None:
            merged = merged.unionByName(old.select(*names, "bucket").withColumn("_age", F.lit(1)))
            merged = keep_first(merged, ["bucket", "point_id"], ["_age"], [*names, "bucket"])
        # Ranging reads its input twice, so the vector arithmetic comes after it.
        ready = prepare_vectors(merged.drop("_age").repartitionByRange("point_id").sortWithinPartitions("point_id"))
        ready.write.option("compression", "zstd").partitionBy("bucket").parquet(f"{data}/load={load}")
        return {"load": load, "buckets": touched, "files": _written(spark, data, load)}

    def touches(entry: dict, other: dict) -> bool:
        return "current" not in other and bool(set(entry["buckets"]) & set(other["buckets"]))

    if touched:
        commits.commit(spark, loads, seen, work, touches)


def load_points(points: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """Upsert points by id: new ones replace old ones with the same id.

    Of several points with one id the last in ``order`` stays (columns that are not
    stored), of equal ones the last row. Points land with their unit vector and
    code, sorted by id. Only the buckets that the new ids fall into are written again.
    """
    spec = require_collection(points.sparkSession, path)
    _load(points, path, spec["generation"], spec["bucket_ids"], order)


def replace_points(points: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """Put ``points`` in the place of all that the collection holds, at once and only when they are written."""
    spark = points.sparkSession
    spec = require_collection(spark, path)
    generation = spec.pop("generation")
    for folder in _folders(path, generation + 1):  # what a replacement that broke off left there
        remove_folder(spark, folder)
    _load(points, path, generation + 1, spec["bucket_ids"], order)
    _new_generation(spark, path, generation, spec)


def drop_old_loads(spark: SparkSession, path: str) -> list[str]:
    """Remove the points of loads that no bucket needs and sum the log up in one entry; gives the loads' names.

    Not while others read or load.
    """
    data, loads = _folders(path, require_collection(spark, path)["generation"])
    log = commits.read_log(spark, loads)
    current = _current(log)
    if not current:
        return []
    gone = sorted({e["load"] for e in log.values() if "load" in e} - set(current.values()))
    if commits.try_append(spark, loads, max(log) + 1, {"current": sorted(current.items()), "files": _files(log)}):
        commits.drop_entries(spark, loads, list(log))
        for load in gone:
            remove_folder(spark, f"{data}/load={load}")
        return gone
    raise commits.Conflict(f"another writer loaded into {path}")


def upload_points(
    points: DataFrame, write_batch: Callable[[list[Row]], None], batch_size: int = UPLOAD_BATCH_ROWS,
) -> None:
    """Hand points to an external store from the tasks, ``batch_size`` rows a call.

    ``write_batch`` must be safe to repeat: a lost task sends its rows again.
    """

    def send(rows: Iterator[Row]) -> None:
        while batch := list(islice(rows, batch_size)):
            write_batch(batch)

    points.foreachPartition(send)


def points_in_range(points: DataFrame, start: int, end: int) -> DataFrame:
    return points.filter((F.col("point_id") >= start) & (F.col("point_id") < end))
