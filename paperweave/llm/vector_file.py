"""Exact top-k search by a vector-approximation file.

Vectors become whole numbers, floor(256 x), and scores are their inner products.

1. Blocks of vectors are packed with one byte per component: the cell of a grid
   over the block's range. Blocks of queries are packed whole.
2. Every block of queries meets every block of cells. The cells give a score and
   the most it can be wrong; what cannot be among the block's best k is ruled out.
3. The k-th best lower bound over all blocks rules out more.
4. Exact vectors are read in the order of their upper bounds: the first k of each
   query, which gives a score that certainly is reached, then only those whose
   bound reaches it.

Of equal vectors only the k + 1 with the smallest ids can be in a result, so the
others are left out before; a vector that fills the table costs nothing more.

Defined results: vectors that are null or hold nulls or values that are not
finite take no part, nor do rows without an id. A shorter vector counts as
ending in zeros. Ties go to the smaller id. Rows with the query's id are its
own. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperweave.llm.common import need, quoted
from paperweave.workspace import stage

SCALE, TOP, CELLS = 256.0, 5, 256
VECTOR_BLOCK, QUERY_BLOCK, SLICE = 8192, 1024, 128
MARGIN = 1e-9  # of the largest possible score: rounding in the bounds


def whole_vectors(rows: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, v): the vectors that take part, as whole numbers."""
    need(rows, id_column, vector)
    x = quoted(vector)
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return rows.filter(quoted(id_column).isNotNull() & x.isNotNull() & ~odd).select(
        quoted(id_column).cast("bigint").alias("id"),
        F.transform(x, lambda c: F.floor(F.lit(SCALE) * c.cast("double")).cast("bigint")).alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of whole numbers, zeros where a vector ends early."""
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    values, offsets = values[offsets[0]:offsets[-1]] if len(offsets) else values, offsets - offsets[0]
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = values
    return out


def _flat(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _pack_cells(block: pa.Table) -> pa.Table:
    """One row: ids, the grid and the cells of a block of vectors."""
    ids, v = _flat(block.column("id")).to_numpy(), _matrix(_flat(block.column("v")))
    low = v.min(axis=0, initial=0) if v.shape[1] else np.zeros(0, np.int64)
    high = v.max(axis=0, initial=0) if v.shape[1] else np.zeros(0, np.int64)
    step = np.maximum((high - low + 1) / CELLS, 1e-12)
    cells = np.minimum((v - low) / step, CELLS - 1).astype(np.uint8)
    return pa.table({
        "vb": block.column("vb").slice(0, 1), "ids": [ids.tobytes()],
        "grid": [np.stack([low.astype(float), step]).tobytes()], "cells": [cells.tobytes()]})


def _pack_queries(block: pa.Table) -> pa.Table:
    ids, v = _flat(block.column("id")).to_numpy(), _matrix(_flat(block.column("v")))
    return pa.table({"qb": block.column("qb").slice(0, 1), "q_ids": [ids.tobytes()], "q": [v.tobytes()]})


def bounds(ids: np.ndarray, grid: np.ndarray, cells: np.ndarray, q_ids: np.ndarray, q: np.ndarray, k: int):
    """(query, id, lower, upper) of what may be among a query's best k in this block."""
    dims = min(grid.shape[1], q.shape[1])
    low, step = grid[:, :dims]
    centres = low + (cells[:, :dims] + 0.5) * step
    largest = np.maximum(np.abs(low), np.abs(low + CELLS * step))
    for i in range(0, len(q_ids), SLICE):
        part = q[i:i + SLICE, :dims].astype(float)
        score = part @ centres.T
        error = np.abs(part) @ (step / 2) + MARGIN * (np.abs(part) @ largest) + 1e-6
        score[q_ids[i:i + SLICE, None] == ids[None, :]] = -np.inf
        if len(ids) > k:
            best = np.partition(score, len(ids) - k, axis=1)[:, len(ids) - k]
        else:
            best = np.full(len(part), -np.inf)
        r, c = np.nonzero((score >= (best - 2 * error)[:, None]) & (score > -np.inf))
        yield q_ids[i + r], ids[c], score[r, c] - error[r], score[r, c] + error[r]


def _meet(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, grid, cells, q_ids, q = (batch.column(i)[row].as_buffer() for i in range(5))
                ids, q_ids = np.frombuffer(ids, np.int64), np.frombuffer(q_ids, np.int64)
                found = bounds(
                    ids, np.frombuffer(grid, float).reshape(2, -1), np.frombuffer(cells, np.uint8).reshape(len(ids), -1),
                    q_ids, np.frombuffer(q, np.int64).reshape(len(q_ids), -1), k)
                for columns in found:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "id", "lower", "upper"])
    return run


def _exact(pairs: DataFrame, vectors: DataFrame, queries: DataFrame) -> DataFrame:
    v = vectors.select("id", "v")
    q = queries.select(F.col("id").alias("query_id"), F.col("v").alias("q"))
    product = F.aggregate(F.zip_with("v", "q", lambda a, b: F.coalesce(a * b, F.lit(0))),
                          F.lit(0).cast("bigint"), lambda s, x: s + x)
    return pairs.join(v, "id").join(q, "query_id").select("query_id", "id", product.alias("score"))


def _kth(rows: DataFrame, value: str, k: int, name: str) -> DataFrame:
    """(query_id, k-th largest value) of the queries that have as many."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(value)))
    return rows.withColumn("_r", rank).filter(F.col("_r") <= k).groupBy("query_id").agg(
        F.min(value).alias(name), F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == k).drop("_n")


def search(
    rows: DataFrame, is_query: Column, id_column: str = "vec_id", vector: str = "embedding", k: int = TOP,
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` best of every row that ``is_query``, a condition on column ``id``."""
    vectors = stage(whole_vectors(rows, id_column, vector), "whole-vectors")
    queries = vectors.filter(is_query).dropDuplicates(["id"])
    rank = F.row_number().over(Window.partitionBy(F.xxhash64("v"), "v").orderBy("id"))
    candidates = stage(vectors.withColumn("_r", rank).filter(F.col("_r") <= k + 1).select("id", "v"), "candidates")

    n_v = max(1, -(-candidates.count() // VECTOR_BLOCK))
    n_q = max(1, -(-queries.count() // QUERY_BLOCK))
    packed = candidates.withColumn("vb", F.pmod(F.xxhash64("id"), F.lit(n_v)).cast("int")).groupBy("vb").applyInArrow(
        _pack_cells, "vb int, ids binary, grid binary, cells binary")
    asked = queries.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(n_q)).cast("int")).groupBy("qb").applyInArrow(
        _pack_queries, "qb int, q_ids binary, q binary")
    grid = packed.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1)))).join(asked, "qb")
    open_pairs = stage(grid.repartition("vb", "qb").select("ids", "grid", "cells", "q_ids", "q").mapInArrow(
        _meet(k), "query_id bigint, id bigint, lower double, upper double"), "open-pairs")

    left = open_pairs.join(_kth(open_pairs, "lower", k, "sure"), "query_id", "left").filter(
        F.col("sure").isNull() | (F.col("upper") >= F.col("sure")))
    turn = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("upper"), "id"))
    left = stage(left.withColumn("turn", turn).select("query_id", "id", "upper", "turn"), "bounds")
    first = stage(_exact(left.filter(F.col("turn") <= k), candidates, queries), "first-scores")
    rest = left.filter(F.col("turn") > k).join(_kth(first, "score", k, "reached"), "query_id", "left").filter(
        F.col("reached").isNull() | (F.col("upper") >= F.col("reached")))
    scored = first.unionByName(_exact(rest, candidates, queries))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return scored.withColumn("rank", place.cast("int")).filter(F.col("rank") <= k).select(
        "query_id", "rank", "id", "score")
