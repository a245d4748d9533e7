"""Papers and points as streams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from paperweave.functions import text
from paperweave.schemas import RAW_PAPERS, SUBJECTS
from paperweave.sources.collections import load_points


HELD_KEYS = 200_000
WAITING = 1 << 16  # rows gathered before they are sorted, at least
GROUPS = 8  # hash groups of keys to a shuffle task
BATCH = 10_000
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_raw_papers(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New NDJSON files below a folder, with the fixed schema.

    ``files_per_batch`` bounds a micro-batch, and with it the rows of a
    frequent id that one state task looks up.
    """
    reader = spark.readStream.schema(RAW_PAPERS).option("mode", "FAILFAST")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def new_papers(raw: DataFrame, seen_for: str, arrival: str = "arrived_at",
               subjects: Sequence[str] = SUBJECTS) -> DataFrame:
    """Papers of the subjects, each id once within ``seen_for`` of its arrival.

    ``arrival`` is a TIMESTAMP column; it bounds the state the stream keeps.
    """
    wanted = raw.filter(text.overlaps(text.split_words(F.col("categories")), list(subjects)))
    return once_per_key(wanted, ["id"], arrival, seen_for)


def _firsts(rows: pa.Table, keys: list[str], order: list[str]) -> pa.Table:
    """The first row of each key in ``order``, the earliest of equal ones; nulls come last."""
    at = pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in order], null_placement="at_end")
    ranked = rows.select(keys).take(at).append_column("_at", pa.array(np.arange(len(at))))
    return rows.take(at.take(ranked.group_by(keys, use_threads=False).aggregate([("_at", "min")])["_at_min"]))


def _first_of(batches: Iterator[pa.RecordBatch], keys: list[str], order: list[str], held: int | None) -> Iterator[pa.RecordBatch]:
    """First rows of all batches. Rows wait until they outnumber those kept, so sorting costs little more than one pass."""
    best, waiting, size = None, [], 0

    def settled() -> pa.Table:
        tables = [] if best is None else [best]
        return _firsts(pa.concat_tables([*tables, pa.Table.from_batches(waiting)]).combine_chunks(), keys, order)

    for batch in batches:
        waiting.append(batch)
        size += batch.num_rows
        if size > max(WAITING, 0 if best is None else len(best)):
            best, waiting, size = settled(), [], 0
            if held is not None and len(best) > held:
                yield from best.to_batches(max_chunksize=BATCH)
                best = None
    if size:
        best = settled()
    if best is not None:
        yield from best.to_batches(max_chunksize=BATCH)


def first_per_task(events: DataFrame, keys: Sequence[str], order: Sequence[str], held: int = HELD_KEYS) -> DataFrame:
    """Each task's first row per key, in ``order``; a stream keeps no state for it.

    A key that holds a large share of the rows sends one row per task to the state.
    A task that meets more than ``held`` keys hands on what it has and starts anew.
    """
    keys, order = list(keys), list(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _first_of(batches, keys, order, held)

    return events.mapInArrow(run, events.schema)


def first_per_key(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Each key's first row of a micro-batch, in ``order``.

    Keys are grouped by hash, several groups to a shuffle task, so the cost of a call is
    shared by many keys; a group holds one row per key and the rows that wait.
    """
    keys, order = list(keys), list(order)
    groups = GROUPS * int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _first_of(batches, keys, order, None)

    return events.groupBy(F.pmod(F.xxhash64(*keys), F.lit(groups))).applyInArrow(run, events.schema)


def once_per_key(
    events: DataFrame, keys: Sequence[str], moment: str, seen_for: str, order: Sequence[str] = (),
) -> DataFrame:
    """One row per key until ``seen_for`` after its ``moment``: the first in (moment, *order) of its micro-batch.

    Later micro-batches change nothing while the key's state lives. Tasks send one
    row per key, and Spark's own deduplication keeps the state, which the watermark
    clears. A null moment is now. State lies in RocksDB, outside the heap, which this
    sets for the session's streams.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    timed = events.withColumn(moment, F.coalesce(F.col(moment).cast("timestamp"), F.current_timestamp()))
    # Names may hold dots; inside plain ones are used.
    plain = {c: f"c{i}" for i, c in enumerate(timed.columns)}
    at, ranked, by = plain[moment], [plain[c] for c in (moment, *order)], [plain[c] for c in keys]
    rows = first_per_key(first_per_task(timed.toDF(*plain.values()), by, ranked), by, ranked)
    return rows.withWatermark(at, seen_for).dropDuplicatesWithinWatermark(by).toDF(*plain)


def write_points(points: DataFrame, path: str, checkpoint: str, order: Sequence[str] = ()) -> DataStreamWriter:
    """Writer that upserts every micro-batch of points, so later ones win and repeats change nothing.

    Inside a micro-batch the last in ``order`` wins (columns that are not stored).
    """

    def load(batch: DataFrame, epoch: int) -> None:
        load_points(batch, path, order)

    return points.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
