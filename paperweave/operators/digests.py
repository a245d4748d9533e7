"""Comparison of two id columns by a tree of digests.

Ids are cut into ranges. For each range and side there is a count and a hash that
doesn't depend on the order, combined in the tasks before the shuffle, so that
two columns that agree move a few numbers per range and task and no ids. A range
is settled when both sides have the same digest and it is that of every id from
its first to its last once. Only ranges that aren't are cut into narrower ones,
and only ids of the narrowest are compared one by one.

Digests have 96 bits (a 64-bit hash under xor, 32 bits of another one added up), so
different sets pass for equal about once in 10^28 comparisons.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperweave.workspace import stage

WIDTHS = (1 << 16, 1 << 8)
MAX_RANGES = 1_000_000  # ranges that are broadcast to find their ids: 30 MB at most


def _range(width: int) -> Column:
    return F.call_function("div", F.col("id"), F.lit(width))


def sides(vectors: DataFrame, records: DataFrame, vec: str = "vec_idx", row: str = "row_idx") -> DataFrame:
    """``id, is_vector`` of both id columns."""
    return vectors.select(F.col(vec).cast("bigint").alias("id"), F.lit(True).alias("is_vector")).unionByName(
        records.select(F.col(row).cast("bigint").alias("id"), F.lit(False).alias("is_vector")))


def range_digests(both: DataFrame, width: int) -> DataFrame:
    """A row per range: ``range_no, first_id, last_id, n_vectors, n_records, settled``.

    Null ids are a range of their own, which is never settled.
    """
    mine, theirs = F.col("is_vector"), ~F.col("is_vector")
    hashed = both.select("id", "is_vector", F.xxhash64("id").alias("_h"), F.hash("id").cast("bigint").alias("_k"))
    ranges = hashed.groupBy(_range(width).alias("range_no")).agg(
        F.min("id").alias("first_id"), F.max("id").alias("last_id"),
        F.count_if(mine).alias("n_vectors"), F.count_if(theirs).alias("n_records"),
        F.bit_xor(F.when(mine, F.col("_h"))).alias("_vh"), F.bit_xor(F.when(theirs, F.col("_h"))).alias("_rh"),
        F.sum(F.when(mine, F.col("_k"))).alias("_vk"), F.sum(F.when(theirs, F.col("_k"))).alias("_rk"))
    same = (F.col("n_vectors") == F.col("n_records")) & (F.col("_vh") == F.col("_rh")) & (F.col("_vk") == F.col("_rk"))
    dense = F.col("last_id") - F.col("first_id") + 1 == F.col("n_records")
    # At most ``width`` ids, and only where all else agrees.
    every = F.aggregate(F.sequence("first_id", "last_id"), F.lit(0).cast("bigint"),
                        lambda got, x: got.bitwiseXOR(F.xxhash64(x)))
    once = F.when(same & dense, every == F.col("_rh"))
    return ranges.select("range_no", "first_id", "last_id", "n_vectors", "n_records",
                         F.coalesce(once, F.lit(False)).alias("settled"))


def _within(both: DataFrame, ranges: DataFrame, width: int) -> DataFrame:
    """Rows whose id lies in one of the ranges, or all rows where the ranges are too many to send to the tasks."""
    n, least, most = ranges.agg(F.count(F.lit(1)), F.min("first_id"), F.max("last_id")).first()
    if least is not None:  # prunes the scan where ids are stored in order
        both = both.filter(F.col("id").between(least, most) | F.col("id").isNull())
    if n > MAX_RANGES:
        return both
    numbers = F.broadcast(ranges.select("range_no"))
    return both.join(numbers, _range(width).eqNullSafe(F.col("range_no")), "left_semi")


def differing_ranges(both: DataFrame, width: int) -> DataFrame:
    """Ranges in which not every id is there once on both sides.

    A range with gaps on both sides can't be settled by digests, so its ids are counted.
    """
    return _descend(both, range_digests(both, width), (width,))[0]


def odd_ids(both: DataFrame, widths: Sequence[int] = WIDTHS, digests: DataFrame | None = None) -> DataFrame:
    """``id, n_vectors, n_records`` of ids that aren't there once on both sides.

    ``digests`` are those of the first width, where they are known.
    """
    return _descend(both, digests if digests is not None else range_digests(both, widths[0]), widths)[1]


def _descend(both: DataFrame, digests: DataFrame, widths: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    rows, open_ranges = both, digests
    for i, width in enumerate(widths):
        open_ranges = stage((digests if i == 0 else range_digests(rows, width)).filter("not settled"), "open-ranges")
        rows = _within(both, open_ranges, width)
    odd = rows.groupBy("id").agg(
        F.count_if("is_vector").alias("n_vectors"), F.count_if(~F.col("is_vector")).alias("n_records")).filter(
        "n_vectors <> 1 or n_records <> 1")
    found = odd.select(_range(widths[-1]).alias("_no")).distinct()
    ranges = open_ranges.drop("settled").join(found, F.col("range_no").eqNullSafe(F.col("_no")), "left_semi")
    return ranges, odd
