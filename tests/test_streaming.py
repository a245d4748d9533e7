"""Streams give what the batch jobs give."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from paperweave.catalog import queries
from paperweave.operators import state
from paperweave.sources import collections as store
from paperweave.sources import state_tables as tables
from paperweave.streaming import ingest, status

SCHEMA = "at bigint, raw string"


def land(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps({"at": a, "raw": json.dumps(r)}) + "\n" for a, r in rows))


def drain(writer):
    run = writer.trigger(availableNow=True).start()
    run.awaitTermination()


def new_state(spark, root):
    tables.recreate_state(spark, root)
    for _ in range(2):
        tables.create_job(spark, root, "m")
    rows = spark.createDataFrame([(1, "b1"), (1, "b2"), (2, "b3")], "job_id bigint, batch_oaid string").withColumns(
        {c: F.lit("x") for c in ("completion_window", "endpoint", "object", "input_file_id", "local_file_id")})
    tables.create_batches(rows.withColumn("created_at", F.current_timestamp()), root, ["batch_oaid"])


def test_refresh_stream(spark, tmp_path):
    root, landed, checkpoint = str(tmp_path / "state"), tmp_path / "landed", str(tmp_path / "check")
    new_state(spark, root)

    def refresh():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(landed))
        drain(status.write_refresh(stream, root, ["at"], checkpoint))

    land(landed, "1.json", (1, {"id": "b1", "status": "in_progress"}), (2, {"id": "b2", "status": "completed"}))
    refresh()
    assert tables.get_job(spark, root, 1)["status"] == "processing"
    assert tables.create_job(spark, root, "m") == 3
    land(landed, "2.json", (3, {"id": "b1", "status": "completed"}), (1, {"id": "b1", "status": "failed"}))
    land(landed, "3.json", (4, {"id": "b3", "status": "expired"}))
    refresh()
    got = {r["batch_oaid"]: r["status"] for r in tables.read_state(spark, root, "batches").collect()}
    assert got == {"b1": "completed", "b2": "completed", "b3": "expired"}
    assert tables.get_job(spark, root, 1)["status"] == "completed"
    assert [tables.get_job(spark, root, n)["status"] for n in (2, 3)] == ["pending", "pending"]


def test_latest_stream_is_batch(spark, tmp_path):
    events = spark.range(500).select((F.col("id") % 3).alias("k"), F.col("id").alias("at"),
                                     F.concat(F.lit("v"), "id").alias("v"))
    path = str(tmp_path / "events")
    events.repartition(5).write.parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(path)
    out = status.latest_status(stream, ["k"], ["at"])
    drain(out.writeStream.outputMode("complete").format("memory").queryName("latest_rows"))
    got = sorted(map(tuple, spark.table("latest_rows").collect()))
    assert got == sorted(map(tuple, state.latest_per_key(events, ["k"], ["at"]).collect()))


def test_paper_stream(spark, tmp_path):
    folder = tmp_path / "papers"
    folder.mkdir()
    for n in range(3):
        rows = [{"id": str(i), "categories": "cs.AI" if i % 2 else "math.CO"} for i in range(n, n + 6)]
        (folder / f"{n}.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
    raw = ingest.stream_raw_papers(spark, str(folder), 1).withColumn("arrived_at", F.current_timestamp())
    out = str(tmp_path / "out")
    drain(ingest.new_papers(raw, "1 day").writeStream.format("parquet").option("path", out)
          .option("checkpointLocation", str(tmp_path / "check")))
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == ["1", "3", "5", "7"]


def test_point_stream(spark, tmp_path):
    path, source = str(tmp_path / "c"), str(tmp_path / "points")
    points = spark.range(40).select(
        F.col("id").alias("point_id"), F.array(F.col("id").cast("float"), F.lit(1.0).cast("float")).alias("vector"),
        F.struct(F.col("id").cast("string").alias("name")).alias("payload"))
    points.repartition(4).write.parquet(source)
    store.create_collection(spark, path, 2)
    stream = spark.readStream.schema(points.schema).option("maxFilesPerTrigger", 1).parquet(source)
    drain(ingest.write_points(stream, path, str(tmp_path / "check")))
    assert sorted(r["point_id"] for r in store.read_points(spark, path).collect()) == list(range(40))


EVENTS = "k string, at timestamp, n int"


def stream_once(spark, folder, files, seen_for, **how):
    """Each list of rows is a micro-batch; gives what came out, by key."""
    (folder / "in").mkdir(parents=True)
    for i, rows in enumerate(files):
        df = spark.createDataFrame([(k, None if at is None else datetime.fromtimestamp(at), n) for k, at, n in rows], EVENTS)
        df.repartition(3).write.mode("append").parquet(str(folder / "in" / f"{i}"))
        stream = spark.readStream.schema(EVENTS).option("recursiveFileLookup", "true").parquet(str(folder / "in"))
        drain(ingest.once_per_key(stream, ["k"], "at", seen_for, ["n"]).writeStream.format("parquet")
              .option("path", str(folder / "out")).option("checkpointLocation", str(folder / "check")))
    return sorted((r["k"] or "", r["n"]) for r in spark.read.parquet(str(folder / "out")).collect())


def test_the_first_row_of_a_key_survives(spark, tmp_path):
    start = 1_700_000_000
    first = [("hot", start + 50 - i % 40, i) for i in range(300)] + [("a", start, 5), ("a", start, 3), (None, start, 1)]
    later = [("hot", start - 5, 1000), ("a", start + 60, 0), ("b", start, 7), (None, start, 9)]
    got = stream_once(spark, tmp_path, [first, later], "1 day")
    assert got == [("", 1), ("a", 3), ("b", 7), ("hot", 39)]


def test_a_key_may_come_again_when_its_state_is_gone(spark, tmp_path):
    start, day = 1_700_000_000, 86_400
    files = [[("a", start, 1)], [("a", start + 10, 2), ("z", start + 5 * day, 3)], [("y", start + 6 * day, 4)], [("a", start + 6 * day, 5)]]
    got = stream_once(spark, tmp_path, files, "1 hour")
    assert got == [("a", 1), ("a", 5), ("y", 4), ("z", 3)]


def test_tasks_send_one_row_per_key(spark):
    """A third of all rows under one key: the state gets at most one of them per task."""
    rows = spark.range(9000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.timestamp_seconds(F.col("id") % 97).alias("at"), (F.col("id") % 1000).cast("int").alias("n"))
    sent = ingest.first_per_task(rows, ["k"], ["at", "n"]).groupBy("k").count().collect()
    assert len(sent) == 51 and max(r["count"] for r in sent) <= 6
    least = rows.groupBy("k").agg(F.min(F.struct("at", "n")).alias("x"))
    few = ingest.first_per_task(rows, ["k"], ["at", "n"], held=10)
    assert few.groupBy("k").agg(F.min(F.struct("at", "n")).alias("x")).exceptAll(least).count() == 0


@pytest.mark.parametrize("files", [0, 3])
def test_a_table_of_one_file_or_a_folder_is_a_stream(spark, tmp_path, files):
    """a table may be a file of its name or a folder of files with other names."""
    vectors = spark.range(60).select(
        F.col("id").alias("vec_id"), F.array_repeat(F.col("id").cast("float") - 30, 64).alias("embedding"),
        (F.col("id") % 10).cast("int").alias("label"))
    if files:
        vectors.repartition(files).write.parquet(str(tmp_path / "embeddings.parquet"))
    else:
        vectors.toPandas().to_parquet(tmp_path / "embeddings.parquet", index=False)
    for name in ("stream_collection", "stream_collection_twice"):
        got = {r["point_id"]: r["label"] for r in queries.QUERIES[name](spark, str(tmp_path)).collect()}
        late = 100 if name.endswith("twice") else 0
        assert got == {i: i % 10 + (late if i % 10 >= 5 else 0) for i in range(60)}


def test_state_is_sparks_own(spark, tmp_path):
    """no call of Python per key; large numbers beside nulls stay whole."""
    big = (1 << 53) + 1
    rows = [(f"k{i % 2000}", datetime.fromtimestamp(1_700_000_000 + i), None if i % 3 else big + i) for i in range(6000)]
    spark.createDataFrame(rows, "k string, at timestamp, n bigint").repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, at timestamp, n bigint").parquet(str(tmp_path / "in"))
    once = ingest.once_per_key(stream, ["k"], "at", "1 day")
    plan = once._jdf.queryExecution().logical().toString()
    assert "Deduplicate" in plan and "TransformWithState" not in plan
    drain(once.writeStream.format("parquet").option("path", str(tmp_path / "out"))
          .option("checkpointLocation", str(tmp_path / "check")))
    got = {r["k"]: r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {f"k{i}": None if i % 3 else big + i for i in range(2000)}


def test_first_per_key_over_several_groups(spark, monkeypatch):
    monkeypatch.setattr(ingest, "WAITING", 5)
    rows = spark.range(3000, numPartitions=6).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 40).alias("k"), F.timestamp_seconds((F.col("id") * 31) % 97).alias("at"), "id")
    least = rows.groupBy("k").agg(F.min(F.struct("at", "id")).alias("x"))
    first = ingest.first_per_key(rows, ["k"], ["at", "id"])
    assert first.count() == 41 and first.select("k", F.struct("at", "id").alias("x")).exceptAll(least).count() == 0


def test_pairs_with_nulls_are_whole(spark, tmp_path):
    """null keys and null moments lose no pair, and come once."""
    rows = [(None if i % 11 == 0 else i % 30, None if i % 13 == 0 else f"t{i % 4}",
             None if i % 17 == 0 else datetime.fromtimestamp(1_700_000_000 + i)) for i in range(3000)]
    events = spark.createDataFrame(rows, "u bigint, t string, at timestamp")
    events.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    drain(ingest.once_per_key(stream, ["u", "t"], "at", "3650 days").writeStream.format("parquet")
          .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")))
    got = [(r["u"], r["t"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert len(got) == len(set(got)) and set(got) == {(u, t) for u, t, _ in rows}
