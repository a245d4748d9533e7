"""Result lines back to the rows that asked for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperweave.operators import digests
from paperweave.operators.dedup import keep_first
from paperweave.operators.order import dense_row_index
from paperweave.schemas import RESULT_LINE
from paperweave.workspace import stage


def parse_lines(lines: DataFrame, data_path: str = "response.data") -> DataFrame:
    """``value`` parsed to ``custom_id`` and ``data``, with ``is_good`` per line.

    A line is good when it has an id and every item of its data has a vector.
    """
    parsed = F.from_json("value", RESULT_LINE[data_path])
    kept = [F.col(c) for c in lines.columns if c != "value"]
    return (
        lines.withColumn("_parsed", parsed)
        .select(*kept, "value", F.col("_parsed.custom_id").alias("custom_id"),
                F.col(f"_parsed.{data_path}").alias("data"))
        .withColumn("is_good", F.coalesce(_is_good(), F.lit(False)))
    )


def _is_good() -> Column:
    return (
        F.col("custom_id").isNotNull() & F.col("data").isNotNull()
        & F.forall("data", lambda item: item["embedding"].isNotNull()
                   & F.forall(item["embedding"], lambda x: x.isNotNull()))
    )


def good_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter("is_good").drop("value", "is_good")


def rejected_lines(parsed: DataFrame) -> DataFrame:
    """Bad lines with the reason, for a report next to the good ones."""
    reason = (
        F.when(F.col("custom_id").isNull(), "no custom_id or not JSON")
        .when(F.col("data").isNull(), "no response data").otherwise("item without vector"))
    return parsed.filter(~F.col("is_good")).select(
        *[c for c in parsed.columns if c not in ("data", "is_good")], reason.alias("reason"))


def reject_counts(parsed: DataFrame, file: str = "source_file") -> DataFrame:
    """Lines, bad lines and vectors per file."""
    bad = F.when(F.col("is_good"), 0).otherwise(1)
    return parsed.groupBy(file).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(bad).alias("n_rejected"),
        F.sum(F.when(F.col("is_good"), F.size("data")).otherwise(0)).alias("n_vectors"))


def first_answers(good: DataFrame) -> DataFrame:
    """One line per request, in the order of files and then of a hash of the content."""
    files = [F.col("source_file")] if "source_file" in good.columns else []
    return keep_first(good, ["custom_id"], [*files, F.xxhash64("data")])


def align_vectors(good: DataFrame, manifest: DataFrame) -> DataFrame:
    """``vec_idx, embedding``: every vector at the row its text came from.

    A request counts once: of repeated answers the first by file and content is
    taken. The join is per request, before the vectors are unrolled: the manifest's
    rows are gathered to one list per request (bounded by the token budget).
    Items beyond a request's texts have no row; ``unmatched_requests`` lists them.
    """
    rows = F.transform(F.array_sort(F.collect_list(F.struct("pos", "row_idx"))), lambda x: x["row_idx"])
    per_request = manifest.groupBy("custom_id").agg(rows.alias("rows"))
    return (
        first_answers(good).select("custom_id", F.col("data.embedding").alias("vectors"))
        .join(per_request, "custom_id")
        .select(F.posexplode("vectors").alias("pos", "embedding"), "rows")
        .select(F.get("rows", F.col("pos")).alias("vec_idx"), "embedding")
        .filter("vec_idx is not null")
    )


def unmatched_requests(good: DataFrame, manifest: DataFrame) -> DataFrame:
    """Requests without an answer or with several, answers without a request, and wrong item counts."""
    asked = manifest.groupBy("custom_id").agg(F.count(F.lit(1)).alias("n_asked"))
    got = good.groupBy("custom_id").agg(
        F.sum(F.size("data")).alias("n_got"), F.count(F.lit(1)).alias("_answers"))
    problem = (
        F.when(F.col("n_got").isNull(), "missing").when(F.col("n_asked").isNull(), "orphan")
        .when(F.col("_answers") > 1, "answered twice")
        .when(F.col("n_got") != F.col("n_asked"), "count differs"))
    return (asked.join(got, "custom_id", "full")
            .withColumn("problem", problem).filter("problem is not null").drop("_answers"))


def vectors_in_order(good: DataFrame, file_order: str = "source_file") -> DataFrame:
    """``vec_idx, embedding`` without a manifest, in the order the texts were asked.

    Batch and request are compared as numbers: as texts, request 1000000 would
    come before 999999 and a batch's later files before its first. Ids of
    another form come first, by file and id.
    """
    def number(part: int) -> Column:
        return F.nullif(F.regexp_extract("custom_id", r"^batch-(\d+)-(\d+)-request-(\d+)$", part), F.lit("")).cast("bigint")

    keys = ["_job", "_batch", "_request", file_order, "custom_id", "pos"]
    items = good.select(
        number(1).alias("_job"), number(2).alias("_batch"), number(3).alias("_request"), file_order, "custom_id",
        F.posexplode("data").alias("pos", "item")).select(*keys, F.col("item.embedding").alias("embedding"))
    return dense_row_index(items, keys, "vec_idx").select("vec_idx", "embedding")


def wrong_dimension(vectors: DataFrame, dim: int | Column, vector: str = "embedding") -> DataFrame:
    """Vectors whose width is not the model's."""
    width = dim if isinstance(dim, Column) else F.lit(dim)
    return vectors.filter(F.col(vector).isNull() | (F.size(vector) != width))


def alignment(vectors: DataFrame, records: DataFrame) -> DataFrame:
    """One row: ``n_vectors, n_records, aligned``."""
    def counted(df: DataFrame, name: str, other: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name)).withColumn(other, F.lit(0).cast("bigint"))

    both = counted(vectors, "n_vectors", "n_records").unionByName(counted(records, "n_records", "n_vectors"))
    return both.agg(F.sum("n_vectors").alias("n_vectors"), F.sum("n_records").alias("n_records")).withColumn(
        "aligned", F.col("n_vectors") == F.col("n_records"))


def require_alignment(vectors: DataFrame, records: DataFrame, vec: str = "vec_idx", row: str = "row_idx") -> int:
    """Number of points; an error unless every id is there once on both sides.

    Counts and digests per range of ids are taken in one pass over both narrow
    columns; ids move only where a range differs.
    """
    both = digests.sides(vectors, records, vec, row)
    ranges = stage(digests.range_digests(both, digests.WIDTHS[0]), "range-digests")
    n_vectors, n_records, n_open = ranges.agg(
        F.coalesce(F.sum("n_vectors"), F.lit(0)), F.coalesce(F.sum("n_records"), F.lit(0)),
        F.count_if(~F.col("settled"))).first()
    if n_vectors != n_records:
        raise ValueError(f"{n_vectors} vectors do not match {n_records} records")
    odd = digests.odd_ids(both, digests=ranges).take(5) if n_open else []
    if odd:
        raise ValueError("vectors do not match records: " + "; ".join(
            f"id {x['id']} has {x['n_vectors']} vectors and {x['n_records']} records" for x in odd))
    return n_vectors


def missing_rows(records: DataFrame, vectors: DataFrame, row: str = "row_idx", vec: str = "vec_idx") -> DataFrame:
    """Records that have no vector."""
    return records.join(vectors.select(F.col(vec).alias(row)), row, "left_anti")


def orphan_rows(vectors: DataFrame, records: DataFrame, vec: str = "vec_idx", row: str = "row_idx") -> DataFrame:
    """Vectors that have no record."""
    return vectors.join(records.select(F.col(row).alias(vec)), vec, "left_anti")
