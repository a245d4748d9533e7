"""Exact cosine top-k over a collection, plain or through the one-bit codes.

The queries are few and shipped to the tasks, a checked number at a time; the
collection is scanned in place and never shuffled. A task keeps the best k per
query while its Arrow batches pass and hands on only those.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperweave.functions.vectors import WORD_BITS, bit_words
from paperweave.operators.order import dense_row_index
from paperweave.workspace import stage

# Scores are compared to this many digits, so that equal vectors tie exactly.
SCORE_DIGITS = 12
_HIT = "query_no int, point_id bigint, score double"
_HIT_ARROW = pa.schema([("query_no", pa.int32()), ("point_id", pa.int64()), ("score", pa.float64())])


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    """A list column of equal widths as a matrix."""
    widths = column.value_lengths()
    if column.null_count or len(widths.unique()) != 1:
        raise ValueError("every point needs a vector of the same width")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(kind)


def _slices(batches: Iterable[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a float64 matrix of their vectors stays near 32 MB."""
    rows = max(1, (1 << 22) // dim)
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _best(hits: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """The k best hits of every query: score down, then lower id."""
    query, point, score = hits
    order = np.lexsort((point, -score, query))
    query, point, score = query[order], point[order], score[order]
    first = np.searchsorted(query, query, side="left")
    keep = np.arange(len(query)) - first < k
    return query[keep], point[keep], score[keep]


def _scan_topk(batches: Iterable[pa.RecordBatch], score_of, queries: int, k: int) -> Iterator[pa.RecordBatch]:
    """Running top-k per query over a task's batches; ``score_of`` gives rows x queries."""
    hits = (np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0))
    floor = np.full(queries, -np.inf)
    for batch in batches:
        # Points without direction have no score and must not fill the best places.
        score = np.nan_to_num(score_of(batch), nan=-np.inf)
        n = len(score)
        cut = np.partition(score, n - k, axis=0)[n - k] if n > k else np.full(queries, -np.inf)
        row, query = np.nonzero((score >= np.maximum(cut, floor)) & np.isfinite(score))
        point = batch.column(0).to_numpy()[row]
        hits = _best((np.concatenate((hits[0], query.astype(np.int32))),
                      np.concatenate((hits[1], point)),
                      np.concatenate((hits[2], score[row, query]))), k)
        full = np.bincount(hits[0], minlength=queries) >= k
        ends = np.searchsorted(hits[0], np.arange(queries), side="right") - 1
        floor[full] = hits[2][ends[full]]
    if len(hits[0]):
        yield pa.RecordBatch.from_arrays([pa.array(h) for h in hits], schema=_HIT_ARROW)


def _rank(hits: DataFrame, k: int, shards: int = 64) -> DataFrame:
    """Global top-k from the tasks' own: first per group of tasks, then over all."""
    best_first = [F.col("score").desc(), F.col("point_id")]
    hits = hits.withColumn("_shard", F.spark_partition_id() % shards)
    for keys in (["query_no", "_shard"], ["query_no"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*best_first))
        hits = hits.withColumn("rank", place).filter(F.col("rank") <= k)
    return hits.drop("_shard")


def _query_blocks(queries: DataFrame, rows: int) -> Iterator[list]:
    """Queries in lists of at most ``rows``; more than one list only when needed."""
    head = queries.take(rows + 1)
    if len(head) <= rows:
        yield head
        return
    numbered = dense_row_index(queries, ["query_id"], "_no")
    for start in range(0, numbered.count(), rows):
        yield numbered.filter(F.col("_no").between(start, start + rows - 1)).collect()


def _per_block(queries: DataFrame, query_id: str, query_vector: str, rows: int, search) -> DataFrame:
    """Run ``search(matrix)`` per block of queries and put the ids back on."""
    source = queries.select(F.col(query_id).cast("bigint").alias("query_id"),
                            F.col(query_vector).alias("query_vector"))
    spark = queries.sparkSession

    def hits(block: list) -> DataFrame:
        matrix = np.array([r["query_vector"] for r in block], np.float64)
        ids = spark.createDataFrame([(i, r["query_id"]) for i, r in enumerate(block)],
                                    "query_no int, query_id bigint")
        return search(matrix).join(F.broadcast(ids), "query_no").select(
            "query_id", "rank", "point_id", "score")

    blocks = _query_blocks(source, rows)
    first, second = next(blocks), next(blocks, None)
    if not first:
        return spark.createDataFrame([], "query_id bigint, rank int, point_id bigint, score double")
    if second is None:
        return hits(first)
    # With several blocks each one is finished before the next is fetched.
    return reduce(DataFrame.unionByName, (
        stage(hits(block), "hits") for block in chain([first, second], blocks)))


def _unit(matrix: np.ndarray) -> np.ndarray:
    with np.errstate(invalid="ignore", divide="ignore"):
        return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def _scan(points: DataFrame, point_id: str, vector: str, matrix: np.ndarray, k: int,
          before=lambda batches: batches, columns: list[str] | None = None) -> DataFrame:
    """Best k by cosine; ``before`` may leave rows out, given ``columns``."""
    target = points.sparkSession.sparkContext.broadcast(_unit(matrix))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit_queries = target.value

        def cosine(batch: pa.RecordBatch) -> np.ndarray:
            return np.round(_unit(_matrix(batch.column(1), "float64")) @ unit_queries.T, SCORE_DIGITS)

        yield from _scan_topk(_slices(before(batches), unit_queries.shape[1]), cosine, len(unit_queries), k)

    narrow = points.select(*columns) if columns else points.select(
        F.col(point_id).cast("bigint").alias("point_id"), F.col(vector).alias("vector"))
    return _rank(narrow.mapInArrow(task, _HIT), k)


def cosine_topk(
    points: DataFrame, queries: DataFrame, k: int, point_id: str = "point_id", vector: str = "vector",
    query_id: str = "query_id", query_vector: str = "query_vector", queries_per_pass: int = 512,
) -> DataFrame:
    """``query_id, rank, point_id, score``: the k nearest points, lower id first on ties.

    More queries than ``queries_per_pass`` take further passes over the points.
    Points with a zero vector have no cosine and are never returned.
    """
    return _per_block(queries, query_id, query_vector, queries_per_pass,
                      lambda matrix: _scan(points, point_id, vector, matrix, k))


# --- through the codes --------------------------------------------------------

def _signs(words: np.ndarray, dim: int) -> np.ndarray:
    """Code words back to one 0/1 column per dimension."""
    bits = np.unpackbits(words.astype(">i8").view(np.uint8), axis=1)
    tail = dim % WORD_BITS
    if tail:
        bits = np.concatenate((bits[:, :-WORD_BITS], bits[:, -tail:]), axis=1)
    return bits


def quantised_topk(
    points: DataFrame, queries: DataFrame, k: int, oversample: int = 4, point_id: str = "point_id",
    vector: str = "vector", code: str = "code", query_id: str = "query_id",
    query_vector: str = "query_vector", queries_per_pass: int = 512,
) -> DataFrame:
    """The result of ``cosine_topk``, with vectors read only where codes leave it open.

    1. The codes alone give the ``k * oversample`` nearest points by Hamming distance.
    2. Their exact scores give each query a score that its k-th best reaches for sure.
    3. A unit vector's score is at most the length of the query over the
       dimensions where the signs agree, so the codes rule out every point whose
       bound stays below that score. What is left is scored exactly.
    """

    def search(matrix: np.ndarray) -> DataFrame:
        spark = points.sparkSession
        dim = matrix.shape[1]
        unit_queries = _unit(matrix)
        positive = (matrix > 0).astype(np.float64)
        signs = spark.sparkContext.broadcast(positive)
        codes = points.select(F.col(point_id).cast("bigint").alias("point_id"), F.col(code).alias("code"))

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            wanted = signs.value

            def closeness(batch: pa.RecordBatch) -> np.ndarray:
                bits = _signs(_matrix(batch.column(1), "int64"), dim).astype(np.float64)
                return -(bits @ (1 - wanted).T + (1 - bits) @ wanted.T)

            yield from _scan_topk(_slices(batches, dim), closeness, len(wanted), k * oversample)

        candidates = _rank(codes.mapInArrow(near, _HIT), k * oversample).select("point_id").distinct()
        vectors = points.select(F.col(point_id).cast("bigint").alias("point_id"), F.col(vector).alias("vector"))
        # At most k * oversample ids for each query of the block: bounded, so never a shuffle of the vectors.
        near_vectors = vectors.join(F.broadcast(candidates), "point_id", "left_semi")
        scored = _scan(near_vectors, "point_id", "vector", matrix, k)
        reached = np.full(len(matrix), -np.inf)
        # One number per query of this block.
        for row in scored.filter(F.col("rank") == k).select("query_no", "score").collect():
            reached[row["query_no"]] = row["score"]
        limits = spark.sparkContext.broadcast((unit_queries ** 2, positive, reached - 1e-6))

        def open_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Id and vector of the points that the codes leave open."""
            square, wanted, least = limits.value
            for batch in _slices(batches, dim):
                bits = _signs(_matrix(batch.column(2), "int64"), dim).astype(np.float64)
                agree = bits @ (square * wanted).T + (1 - bits) @ (square * (1 - wanted)).T
                left = batch.select([0, 1]).filter(pa.array((np.sqrt(agree) >= least).any(axis=1)))
                if left.num_rows:
                    yield left

        # Codes and vectors pass side by side: no join, and only open rows are scored.
        both = points.select(F.col(point_id).cast("bigint").alias("point_id"), F.col(vector).alias("vector"),
                             F.col(code).alias("code"))
        return _scan(both, "point_id", "vector", matrix, k, open_rows, ["point_id", "vector", "code"])

    return _per_block(queries, query_id, query_vector, queries_per_pass, search)


def with_codes(points: DataFrame, vector: str = "vector", code: str = "code") -> DataFrame:
    return points.withColumn(code, bit_words(F.col(vector)))
