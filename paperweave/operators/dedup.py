"""Keep-first de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], keep: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key, the first in ``order``; null keys form one group.

    Spark limits each key to its first row inside every map task before the
    shuffle, so a key that holds a large share of the rows sends one row per task.
    ``keep`` names the columns wanted; others do not go through the shuffle.
    """
    names = list(keep) if keep is not None else df.columns
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).select(*[F.col(f"`{c}`") for c in names])


def keep_first_text(
    df: DataFrame, text: str, order: Sequence[str | Column], keep: Sequence[str] | None = None,
) -> DataFrame:
    """``keep_first`` by a long text: rows are sorted and dealt out by its 256-bit digest.

    A text that is not in ``keep`` stays out of the shuffle.
    """
    digest = F.unhex(F.sha2(F.col(text), 256))
    return keep_first(df.withColumn("_digest", digest), ["_digest"], order,
                      [c for c in df.columns] if keep is None else keep)
