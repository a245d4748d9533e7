"""Points of a vector collection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperweave.functions.vectors import bit_words, unit_normalize
from paperweave.operators.order import chunk_id
from paperweave.schemas import LOAD_CHUNK_ROWS


def collection_points(
    vectors: DataFrame, papers: DataFrame, payload: Sequence[str] | None = None,
    vec: str = "vec_idx", row: str = "row_idx", vector: str = "embedding",
) -> DataFrame:
    """``point_id, vector, payload``: vectors and paper rows joined one to one."""
    names = list(payload) if payload else [c for c in papers.columns if c != row]
    records = papers.select(F.col(row).alias("point_id"),
                            F.struct(*[F.col(f"`{c}`").alias(c) for c in names]).alias("payload"))
    points = vectors.select(F.col(vec).alias("point_id"), F.col(vector).alias("vector"))
    # Both sides are wide; neither should be gathered on the driver for a
    # broadcast because its file is well compressed.
    return points.join(records.hint("merge"), "point_id").select("point_id", "vector", "payload")


def prepare_vectors(points: DataFrame, vector: str = "vector") -> DataFrame:
    """Points with the unit vector for cosine scores and its one-bit code."""
    return points.withColumns({"unit": unit_normalize(F.col(vector)), "code": bit_words(F.col(vector))})


def with_load_chunk(points: DataFrame, size: int = LOAD_CHUNK_ROWS) -> DataFrame:
    return points.withColumn("chunk", chunk_id("point_id", size, 0, 0))
