"""Collections, vector expressions and search against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperweave.functions import vectors as v
from paperweave.operators import collection, search
from paperweave.plans import load
from paperweave.sources import collections as store


def frame(spark, rows, names="point_id bigint, vector array<float>"):
    return spark.createDataFrame(rows, names)


def random_points(spark, n=400, dim=70, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    rows = (centres[rng.integers(0, 8, n)] + 0.4 * rng.normal(size=(n, dim))).astype(np.float32)
    rows[5] = rows[4]          # equal vectors tie
    rows[1] = 0                # no direction
    # A third of the points are copies of one vector.
    rows[np.arange(n) % 3 == 2] = rows[2]
    return rows, frame(spark, [(i, r.tolist()) for i, r in enumerate(rows)]).repartition(6)


def brute(points, queries, k):
    out = {}
    with np.errstate(invalid="ignore"):
        unit = points.astype(float) / np.linalg.norm(points.astype(float), axis=1, keepdims=True)
    for i, q in enumerate(queries.astype(float)):
        score = np.round(unit @ (q / np.linalg.norm(q)), 12)
        ids = [j for j in range(len(points)) if np.isfinite(score[j])]
        out[i] = sorted(ids, key=lambda j: (-score[j], j))[:k]
    return out


def ranked(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["point_id"])
    return got


@pytest.mark.parametrize("per_pass", [512, 4])
def test_topk(spark, per_pass):
    rows, points = random_points(spark)
    queries = rows[[0, 2, 4, 9, 13, 21, 30, 33, 50]]
    asked = frame(spark, [(i, q.tolist()) for i, q in enumerate(queries)], "query_id bigint, query_vector array<float>")
    want = brute(rows, queries, 12)
    assert ranked(search.cosine_topk(points, asked, 12, queries_per_pass=per_pass)) == want
    coded = search.with_codes(points)
    for oversample in (1, 4):
        assert ranked(search.quantised_topk(coded, asked, 12, oversample, queries_per_pass=per_pass)) == want


def test_topk_of_few_points(spark):
    rows, points = random_points(spark, 6, 5)
    asked = frame(spark, [(0, [1.0, 0.0, 0.0, 0.0, 0.0])], "query_id bigint, query_vector array<float>")
    want = brute(rows, np.array([[1.0, 0, 0, 0, 0]]), 50)
    assert ranked(search.cosine_topk(points, asked, 50)) == want
    assert ranked(search.quantised_topk(search.with_codes(points), asked, 50)) == want
    assert search.cosine_topk(points, asked.limit(0), 5).count() == 0


def test_many_points_without_direction(spark):
    rows = np.zeros((300, 8), np.float32)
    rows[::3] = np.random.default_rng(1).normal(size=(100, 8))
    points = frame(spark, [(i, r.tolist()) for i, r in enumerate(rows)]).coalesce(1)
    asked = frame(spark, [(0, rows[0].tolist())], "query_id bigint, query_vector array<float>")
    want = brute(rows, rows[:1], 20)
    assert ranked(search.cosine_topk(points, asked, 20)) == want
    assert ranked(search.quantised_topk(search.with_codes(points), asked, 20)) == want


def test_uneven_width_is_an_error(spark):
    points = frame(spark, [(0, [1.0, 2.0]), (1, [1.0])]).coalesce(1)
    asked = frame(spark, [(0, [1.0, 0.0])], "query_id bigint, query_vector array<float>")
    with pytest.raises(Exception, match="same width"):
        search.cosine_topk(points, asked, 1).collect()


def test_unit_and_bits(spark):
    df = frame(spark, [(0, [3.0, 4.0]), (1, [0.0, 0.0]), (2, [-1.0, 0.0]), (3, []), (4, None)])
    rows = df.select("point_id", v.unit_normalize(F.col("vector")).alias("u"),
                     v.bit_string(F.col("vector")).alias("b"),
                     v.bit_words(F.col("vector")).alias("w")).orderBy("point_id").collect()
    assert rows[0]["u"] == pytest.approx([0.6, 0.8])
    assert rows[1]["u"] == [None, None]
    assert [r["b"] for r in rows] == ["11", "00", "00", "", None]
    assert [r["w"] for r in rows] == [[3], [0], [0], [], None]


@pytest.mark.parametrize("dim", [1, 63, 64, 65, 130])
def test_words_hold_all_bits(spark, dim):
    rng = np.random.default_rng(dim)
    rows = rng.normal(size=(20, dim)).astype(np.float32)
    df = frame(spark, [(i, r.tolist()) for i, r in enumerate(rows)]).select(
        "point_id", v.bit_words(F.col("vector")).alias("w"))
    got = df.orderBy("point_id").collect()
    words = np.array([r["w"] for r in got], np.int64)
    assert np.array_equal(search._signs(words, dim), (rows > 0).astype(np.uint8))
    first = got[0]["w"]
    distance = df.select("point_id", v.hamming(F.col("w"), F.array(*[F.lit(x) for x in first])).alias("d"))
    assert [r["d"] for r in distance.orderBy("point_id").collect()] == [
        int(((rows[0] > 0) != (r > 0)).sum()) for r in rows]


def point_rows(spark, ids, label):
    return spark.createDataFrame([(i, [float(i), 1.0], (label,)) for i in ids],
                                 "point_id bigint, vector array<float>, payload struct<name:string>")


def test_collection_life(spark, tmp_path):
    path = str(tmp_path / "c")
    with pytest.raises(FileNotFoundError):
        store.require_collection(spark, path)
    store.create_collection(spark, path, 2)
    with pytest.raises(FileExistsError):
        store.create_collection(spark, path, 2)
    store.load_points(point_rows(spark, [0, 1, 2], "a"), path)
    store.load_points(point_rows(spark, [2, 3], "b"), path)
    rows = store.read_points(spark, path).orderBy("point_id").collect()
    assert [(r["point_id"], r["payload"]["name"]) for r in rows] == [(0, "a"), (1, "a"), (2, "b"), (3, "b")]
    assert rows[0]["unit"] == [0.0, 1.0] and rows[0]["code"] == [1]
    assert store.points_in_range(store.read_points(spark, path), 1, 3).count() == 2
    store.load_points(point_rows(spark, [4, 5], "c"), path)
    store.load_points(point_rows(spark, [4, 5], "c"), path)
    assert store.read_points(spark, path).count() == 6
    # A load that broke off before its commit.
    ready = point_rows(spark, [9], "lost").withColumn("bucket", F.lit(0))
    ready.write.partitionBy("bucket").parquet(f"{path}/points/generation=1/load=00000005-x")
    assert store.read_points(spark, path).count() == 6
    store.load_points(point_rows(spark, [7], "d"), path)
    assert store.read_points(spark, path).count() == 7
    assert [name[:8] for name in store.drop_old_loads(spark, path)] == [f"{n:08d}" for n in (1, 2, 3, 4)]
    assert store.drop_old_loads(spark, path) == []
    assert store.read_points(spark, path).count() == 7
    store.empty_collection(spark, path)
    assert store.read_points(spark, path) is None
    assert store.require_collection(spark, path)["dim"] == 2


def test_loads_touch_only_their_buckets(spark, tmp_path):
    path = str(tmp_path / "c")
    store.create_collection(spark, path, 2, bucket_ids=10)
    store.load_points(point_rows(spark, range(100), "a"), path)
    store.load_points(point_rows(spark, [33, 34, 33], "b"), path)
    written = spark.read.parquet(f"{path}/points/generation=1/load=00000002-*")
    assert sorted(r["point_id"] for r in written.collect()) == list(range(30, 40))
    rows = store.read_points(spark, path).collect()
    assert len(rows) == 100 and sorted(r["point_id"] for r in rows if r["payload"]["name"] == "b") == [33, 34]


def test_a_range_opens_only_files_that_can_hold_it(spark, tmp_path):
    path = str(tmp_path / "c")
    store.create_collection(spark, path, 2, bucket_ids=10)
    assert store.read_range(spark, path, 0, 10) is None and store.point_count(spark, path) == 0
    store.load_points(point_rows(spark, range(100), "a"), path)
    store.load_points(point_rows(spark, [33, 34, 205], "b"), path)

    def found(start, end):
        return sorted((r["point_id"], r["payload"]["name"]) for r in store.read_range(spark, path, start, end).collect())

    def check():
        assert found(32, 36) == [(32, "a"), (33, "b"), (34, "b"), (35, "a")]
        assert found(95, 300) == [(i, "a") for i in range(95, 100)] + [(205, "b")]
        assert found(100, 200) == found(50, 50) == []
        assert len(found(-5, 1000)) == store.point_count(spark, path) == 101
        opened = store.read_range(spark, path, 32, 36).inputFiles()
        assert all("load=00000002" in f and "bucket=3/" in f for f in opened) and len(opened) <= 2
        assert store.read_range(spark, path, 0, 1).columns == store.read_points(spark, path).columns

    check()
    store.drop_old_loads(spark, path)  # the log is summed up in one entry
    check()
    store.load_points(point_rows(spark, [1], "c"), path)
    assert found(0, 3) == [(0, "a"), (1, "c"), (2, "a")] and found(33, 34) == [(33, "b")]


def labels(spark, path):
    return {r["point_id"]: r["payload"]["name"] for r in store.read_points(spark, path).collect()}


def test_last_point_of_a_load_wins(spark, tmp_path):
    path = str(tmp_path / "c")
    store.create_collection(spark, path, 2, bucket_ids=10)
    sent = point_rows(spark, [1, 2], "a").unionByName(point_rows(spark, [2, 15], "b")).unionByName(point_rows(spark, [2], "c"))
    store.load_points(sent.coalesce(1), path)
    assert labels(spark, path) == {1: "a", 2: "c", 15: "b"}
    rows = [(2, [0.0, 1.0], (f"v{n}",), n) for n in (3, 9, 4)] + [(1, [0.0, 1.0], ("z",), 0)]
    moved = spark.createDataFrame(rows, "point_id bigint, vector array<float>, payload struct<name:string>, at int")
    store.load_points(moved.repartition(4), path, ["at"])
    assert labels(spark, path) == {1: "z", 2: "v9", 15: "b"}
    assert "at" not in store.read_points(spark, path).columns


def test_loads_of_two_writers(spark, tmp_path, monkeypatch):
    """A load that commits while another one is under way: into the same bucket and into others."""
    path, inside = str(tmp_path / "c"), []
    store.create_collection(spark, path, 2, bucket_ids=10)
    store.load_points(point_rows(spark, range(30), "old"), path)
    plain = store.commits.try_append

    def later(spark_, folder, number, entry):
        if "load" in entry and not inside:
            inside.append(1)  # the other writer comes first
            store.load_points(point_rows(spark, [3, 4, 25, 40], "other"), path)
        return plain(spark_, folder, number, entry)

    monkeypatch.setattr(store.commits, "try_append", later)
    store.load_points(point_rows(spark, [4, 5], "mine"), path)
    want = {i: "old" for i in range(30)} | {3: "other", 25: "other", 40: "other", 4: "mine", 5: "mine"}
    assert labels(spark, path) == want
    again = [p for p in (tmp_path / "c/points/generation=1").iterdir()]
    inside.clear()
    store.load_points(point_rows(spark, [12], "mine"), path)  # no bucket in common with [3, 4, 25, 40]
    want |= {3: "other", 4: "other", 25: "other", 12: "mine"}
    assert labels(spark, path) == want
    # The untouched load was written once; the one in conflict twice.
    assert len(list((tmp_path / "c/points/generation=1").iterdir())) == len(again) + 2 and len(again) == 4


def test_an_endless_conflict_is_an_error(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "c")
    store.create_collection(spark, path, 2)
    monkeypatch.setattr(store.commits, "try_append", lambda *a: False)
    with pytest.raises(store.commits.Conflict):
        store.load_points(point_rows(spark, [1], "a"), path)


def test_failed_recreate_leaves_the_points(spark, tmp_path):
    path = str(tmp_path / "c")
    store.create_collection(spark, path, 2)
    papers = spark.createDataFrame([(0, "x"), (1, "y")], "row_idx bigint, title string")
    vectors = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 0.0])], "vec_idx bigint, embedding array<float>")
    assert load.run(vectors, papers, path) == 2
    with pytest.raises(Exception):
        load.run(vectors.limit(1), papers, path, recreate=True)
    wide = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_idx bigint, embedding array<float>")
    with pytest.raises(Exception):
        load.run(wide, papers, path, recreate=True)
    assert store.read_points(spark, path).count() == 2
    one = papers.filter("row_idx = 0")
    assert load.run(vectors.filter("vec_idx = 0"), one, path, recreate=True) == 1
    assert [r["point_id"] for r in store.read_points(spark, path).collect()] == [0]
    assert store.require_collection(spark, path)["generation"] == 2


def test_upload_in_batches(spark, tmp_path):
    folder = str(tmp_path)

    def write_batch(rows):
        import uuid
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
            out.write(",".join(str(r["point_id"]) for r in rows))

    store.upload_points(point_rows(spark, range(25), "a").coalesce(2), write_batch, 10)
    parts = [p.read_text().split(",") for p in tmp_path.iterdir()]
    assert sorted(int(i) for p in parts for i in p) == list(range(25))
    assert max(map(len, parts)) == 10


def test_points_and_chunks(spark):
    papers = spark.createDataFrame([(0, "x", "j"), (1, None, "k")], "row_idx bigint, title string, `journal-ref` string")
    vectors = spark.createDataFrame([(1, [1.0]), (0, [2.0])], "vec_idx bigint, embedding array<float>")
    rows = collection.with_load_chunk(collection.collection_points(vectors, papers), 1).orderBy("point_id").collect()
    assert [(r["point_id"], r["vector"], r["payload"]["title"], r["payload"]["journal-ref"], r["chunk"])
            for r in rows] == [(0, [2.0], "x", "j", 0), (1, [1.0], None, "k", 1)]


def test_model_dimension(spark):
    df = spark.createDataFrame([("Qwen/Qwen3-Embedding-8B",)], "m string")
    assert df.select(v.model_dimension(F.col("m"))).first()[0] == 4096
    for bad in ("other", None):
        with pytest.raises(Exception, match="unknown model"):
            spark.createDataFrame([(bad,)], "m string").select(v.model_dimension(F.col("m"))).collect()
