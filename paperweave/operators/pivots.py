"""Exact cosine top-k that leaves whole groups of points unread.

A pivot table holds points in cells: a point's nearest pivot and a ring of angles
around it. Angles obey the triangle inequality, so the smallest and largest angle
of a cell bound the score of all its points for any query. A search reads cells in
the order of their bounds, each from a folder of its own, until no unread cell can
hold a better point than the k-th found. The result is that of a full scan.

Pivots are a bounded sample; every point is in a cell. How much is left unread
depends on the data: clustered points leave most of it, random directions nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperweave.operators.search import _HIT, _matrix, _per_block, _rank, _scan, _slices, _unit
from paperweave.workspace import stage

PIVOTS = 64
SAMPLE_PER_PIVOT = 8  # rows that pivots are chosen from, for each pivot
RING = 0.125          # radians
RINGS = int(np.pi / RING) + 1
LEAST_CHANGE = 1e-6   # far above what rounding does to angles and scores

_PLACED = pa.schema([("point_id", pa.int64()), ("vector", pa.list_(pa.float32())), ("cell", pa.int32()), ("angle", pa.float64())])
_PLACED_DDL = "point_id bigint, vector array<float>, cell int, angle double"
_CELL = "cell int, points bigint, least double, most double"


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def choose_pivots(points: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    """Unit vectors far from each other, out of ``SAMPLE_PER_PIVOT * pivots`` points taken by a hash of their ids.

    Copies of one vector are one pivot at most, however many there are.
    """
    finite = F.forall("vector", lambda x: F.abs(x) < float("inf"))
    rows = points.filter(finite & F.exists("vector", lambda x: x != 0)).orderBy(
        F.xxhash64("point_id"), "point_id").limit(SAMPLE_PER_PIVOT * pivots).collect()
    if not rows:
        return np.empty((0, 0))
    sample = _unit(np.array([r["vector"] for r in rows], np.float64))
    chosen, nearest = [0], sample @ sample[0]
    while len(chosen) < pivots and nearest.min() < 1 - LEAST_CHANGE:
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, sample @ sample[chosen[-1]])
    return sample[chosen]


def write_pivot_table(points: DataFrame, path: str, point_id: str = "point_id", vector: str = "vector",
                      pivots: int = PIVOTS) -> None:
    """Write ``points`` in cells below ``path``, with their pivots and the angles of each cell.

    Vectors are shuffled once, by cell; adaptive execution splits a cell that holds
    many points. Points without direction, or with NaN or infinite elements, have no
    cosine and are left out; null vectors and vectors of another width are an error,
    as in the plain search.
    """
    spark = points.sparkSession
    narrow = points.select(F.col(point_id).cast("bigint").alias("point_id"), F.col(vector).cast("array<float>").alias("vector"))
    matrix = choose_pivots(narrow, pivots)
    centres = spark.sparkContext.broadcast(matrix)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot = centres.value
        for batch in _slices(batches, max(1, pivot.shape[1])):
            vectors = _matrix(batch.column(1), "float64")
            unit = _unit(vectors)
            directed = np.flatnonzero(np.isfinite(unit).all(axis=1))
            if not len(directed):
                continue
            cosines = unit[directed] @ pivot.T
            nearest = cosines.argmax(axis=1)
            angle = _angles(cosines[np.arange(len(directed)), nearest])
            cell = nearest * RINGS + (angle / RING).astype(np.int64)
            kept = batch.take(pa.array(directed))
            yield pa.RecordBatch.from_arrays(
                [kept.column(0), kept.column(1).cast(pa.list_(pa.float32())), pa.array(cell.astype(np.int32)), pa.array(angle)],
                schema=_PLACED)

    placed = narrow.mapInArrow(place, _PLACED_DDL).hint("rebalance", "cell").sortWithinPartitions("cell", "angle")
    placed.write.partitionBy("cell").option("compression", "zstd").parquet(f"{path}/points")
    stored = spark.read.schema(_PLACED_DDL).parquet(f"{path}/points")
    stored.groupBy("cell").agg(F.count(F.lit(1)).alias("points"), F.min("angle").alias("least"),
                               F.max("angle").alias("most")).coalesce(1).write.parquet(f"{path}/cells")
    # Last, so that a table that broke off is not found.
    spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(matrix)], "pivot int, vector array<double>").coalesce(
        1).write.parquet(f"{path}/pivots")


def _read_cells(spark: SparkSession, path: str, cells: list[int]) -> DataFrame:
    return spark.read.schema(_PLACED_DDL).option("basePath", f"{path}/points").parquet(
        *[f"{path}/points/cell={c}" for c in cells])


def cell_bounds(unit_queries: np.ndarray, pivots: np.ndarray, cell: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Queries x cells: no point of the cell has a higher cosine."""
    angle = _angles(unit_queries @ pivots.T)[:, cell // RINGS]
    return np.cos(np.maximum(0.0, np.maximum(angle - most, least - angle)))


def _enough(bound: np.ndarray, points: np.ndarray, k: int) -> np.ndarray:
    """For each query its best cells, until they hold k points."""
    order = np.argsort(-bound, axis=1, kind="stable")
    held = np.cumsum(points[order], axis=1)
    needed = np.minimum((held < k).sum(axis=1) + 1, bound.shape[1])
    return np.unique(np.concatenate([o[:n] for o, n in zip(order, needed)]))


def pivot_topk(spark: SparkSession, path: str, queries: DataFrame, k: int, query_id: str = "query_id",
               query_vector: str = "query_vector", queries_per_pass: int = 512, visited: list | None = None) -> DataFrame:
    """``query_id, rank, point_id, score``: the result of ``cosine_topk`` over the points of a pivot table.

    Each wave reads at most as many cells as the waves before it together, best bounds
    first. ``visited`` receives the cells that each wave read. A query without
    direction has no hits.
    """
    pivots = np.array([r["vector"] for r in spark.read.parquet(f"{path}/pivots").orderBy("pivot").collect()], np.float64)
    # At most a row per pivot and ring.
    cells = spark.read.schema(_CELL).parquet(f"{path}/cells").orderBy("cell").collect()
    cell = np.array([c["cell"] for c in cells], np.int64)
    points = np.array([c["points"] for c in cells], np.int64)
    least, most = (np.array([c[name] for c in cells], np.float64) for name in ("least", "most"))

    def search(matrix: np.ndarray) -> DataFrame:
        unit_queries = _unit(matrix)
        directed = np.isfinite(unit_queries).all(axis=1)
        found = spark.createDataFrame([], f"{_HIT}, rank int")
        if not len(cell) or not directed.any():
            return found
        bound = cell_bounds(unit_queries[directed], pivots, cell, least, most)
        reached = np.full(len(bound), -np.inf)
        row_of = {int(q): i for i, q in enumerate(np.flatnonzero(directed))}
        read = np.zeros(len(cell), bool)
        wave = _enough(bound, points, k)
        while len(wave):
            read[wave] = True
            if visited is not None:
                visited.append(cell[wave].tolist())
            hits = _scan(_read_cells(spark, path, cell[wave].tolist()), "point_id", "vector", matrix, k).drop("rank")
            found = stage(_rank(hits.unionByName(found.drop("rank")), k), "pivot-hits")
            # One number per query of this block.
            for r in found.filter(F.col("rank") == k).select("query_no", "score").collect():
                reached[row_of[r["query_no"]]] = r["score"]
            gain = np.where(read, -np.inf, (bound - reached[:, None]).max(axis=0))
            ahead = np.argsort(-gain, kind="stable")
            wave = ahead[gain[ahead] >= -LEAST_CHANGE][:int(read.sum())]
        return found

    return _per_block(queries, query_id, query_vector, queries_per_pass, search)
