"""Job 1: raw paper metadata to the clean, numbered paper table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperweave.functions import text
from paperweave.operators.dedup import keep_first
from paperweave.operators.order import dense_row_index
from paperweave.schemas import CLEAN_COLUMNS, SUBJECTS
from paperweave.sources import papers as source


def select_papers(
    raw: DataFrame, subjects: Sequence[str] = SUBJECTS, order: Sequence[str] = source.POSITION,
) -> DataFrame:
    """Papers of the subjects, one per id: the first in ``order``."""
    kept = (
        raw.withColumn("categories_parsed", text.split_words(F.col("categories")))
        .filter(text.overlaps(F.col("categories_parsed"), list(subjects))))
    # Of the versions only the last one's date goes through the shuffle.
    narrow = kept.select(
        *order, *[F.col(f"`{c}`") for c in CLEAN_COLUMNS if c in kept.columns],
        text.last_item(F.col("versions"))["created"].alias("last_created"))
    return keep_first(narrow, ["id"], order)


def tidy_papers(papers: DataFrame) -> DataFrame:
    """Tidy texts and names, the last version's date; other columns stay in front."""
    tidy = papers.withColumns({
        "title": text.collapse_spaces(F.col("title")),
        "abstract": text.collapse_spaces(F.col("abstract")),
        "authors_parsed": text.display_names(F.col("authors_parsed")),
        "last_submitted": text.parse_http_date(F.col("last_created")),
    })
    front = [c for c in papers.columns if c not in CLEAN_COLUMNS and c != "last_created"]
    return tidy.select(*front, *[F.col(f"`{c}`") for c in CLEAN_COLUMNS])


def clean_papers(
    raw: DataFrame, subjects: Sequence[str] = SUBJECTS, order: Sequence[str] = source.POSITION,
) -> DataFrame:
    """Filter, keep first, tidy; the text rules come last and see the fewest rows."""
    return tidy_papers(select_papers(raw, subjects, order))


def run(spark: SparkSession, raw_path: str, clean_path: str | None = None,
        subjects: Sequence[str] = SUBJECTS) -> str:
    """Read, clean, number by source position and write; gives the path written.

    Numbering reads its input twice (range bounds, then rows), so the text rules
    are left for the final write, which passes over the numbered rows anyway.
    """
    target = source.require_suffix(clean_path or source.default_clean_path(raw_path), ".parquet")
    raw = source.with_position(source.read_raw_papers(spark, raw_path))
    numbered = dense_row_index(select_papers(raw, subjects), source.POSITION)
    return source.write_papers(tidy_papers(numbered.drop(*source.POSITION)), target)
