"""Dense row numbers and chunk numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperweave.workspace import stage


def dense_row_index(
    df: DataFrame,
    keys: Sequence[str],
    name: str = "row_idx",
    start: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    """Number rows ``start``, ``start + 1``, … in the order of ``keys``.

    ``keys`` should be a total order. The rows are range-partitioned, sorted and
    written once; a row's number is its position in its file plus the rows of
    all earlier files. One shuffle, no single-task window over rows, and numbers
    that stay the same when a task is run again.

    Ranges keep their order in the task numbers of the file names, so file
    lengths are all that is needed: a table with a row per written task, at
    most the number of shuffle tasks of the session, which bounds the broadcast.
    """
    size = (partitions,) if partitions else ()
    # One file per task, whatever the session says of rows per file; two would share their numbers.
    table = stage(df.repartitionByRange(*size, *keys).sortWithinPartitions(*keys), "ordered", maxRecordsPerFile=0)
    task = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("bigint")
    placed = table.select("*", task.alias("__task"), F.col("_metadata.row_index").alias("__at"))
    lengths = table.select(task.alias("__task"), F.col("_metadata.file_name").alias("__file")).groupBy("__task").agg(
        F.count(F.lit(1)).alias("n"), (F.min("__file") == F.max("__file")).alias("__one")).withColumn(
        "n", F.when(F.col("__one"), F.col("n")).otherwise(F.raise_error(F.lit("a task wrote several files"))))
    before = F.sum("n").over(Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1))
    # Fixed once: the offsets are read again with every use of the numbers.
    offsets = stage(lengths.select("__task", (F.coalesce(before, F.lit(0)) + F.lit(start)).alias("__offset")), "offsets")
    return placed.join(F.broadcast(offsets), "__task").select(
        (F.col("__offset") + F.col("__at")).alias(name), *[F.col(f"`{c}`") for c in df.columns])


def chunk_id(number: str | Column, size: int, first_number: int = 1, first_chunk: int = 1) -> Column:
    """Chunk of a dense number when every chunk takes ``size`` numbers."""
    column = F.col(number) if isinstance(number, str) else number
    return F.call_function("div", column - F.lit(first_number), F.lit(size)) + F.lit(first_chunk)


def chunk_ranges(df: DataFrame, number: str, size: int) -> DataFrame:
    """[start, end) and row count of every chunk of a dense zero-based number."""
    return (
        df.groupBy(chunk_id(number, size, 0, 0).alias("chunk"))
        .agg(
            F.min(number).alias("start"),
            (F.max(number) + 1).alias("end"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )


def row_slice(df: DataFrame, number: str, start: int, length: int) -> DataFrame:
    """Rows ``start`` to ``start + length``, as a range filter; a stored number is pruned in the scan."""
    return df.filter((F.col(number) >= start) & (F.col(number) < start + length))
