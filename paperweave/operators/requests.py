"""From texts to requests, batches and files.

Texts are read twice and written once: first only their sizes are taken, and
requests, batches and files are settled on those narrow rows; then every text
goes straight to the file it belongs to, through one shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperweave.functions import naming
from paperweave.functions.tokens import token_count
from paperweave.operators.order import chunk_id
from paperweave.operators.packing import OpenBin, pack_next_fit
from paperweave.workspace import stage

ENDPOINT = "/v1/embeddings"
FILE_KEYS = ["job_id", "batch_id", "file_no"]
MAX_CUTS = 1_000_000  # file intervals that are broadcast: 60 MB at most


# --- the line format ------------------------------------------------------------

def json_string(text: Column) -> Column:
    """A text as a JSON string literal; non-ASCII characters stay as they are."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def json_bytes(text: Column) -> Column:
    """Bytes of ``json_string(text)``, with the text rendered once."""
    return F.octet_length(F.to_json(F.array(text))) - 2


def _line(custom_id: Column, model: str, inputs: Column) -> Column:
    # Separators are ', ' and ': '. Line sizes decide where files roll, so the
    # spacing is part of the format.
    return F.concat(
        F.lit('{"custom_id": "'), custom_id,
        F.lit(f'", "method": "POST", "url": "{ENDPOINT}", "body": {{"model": '),
        json_string(F.lit(model)), F.lit(', "input": ['), inputs, F.lit("]}}"))


def _line_bytes(custom_id: Column, model: str, text_bytes: Column, texts: Column) -> Column:
    """Size of a line with its newline, from the sizes of its text literals."""
    empty = F.octet_length(_line(custom_id, model, F.lit("")))
    return empty + text_bytes + 2 * (texts - 1) + 1


# --- sizes, requests, batches ----------------------------------------------------

def weigh_texts(texts: DataFrame, count: Callable[[Column], Column] = token_count) -> DataFrame:
    """``row_idx, token_count, text_bytes`` of every text; null texts are left out."""
    return texts.filter(F.col("text").isNotNull()).select(
        "row_idx", count(F.col("text")).alias("token_count"),
        json_bytes(F.col("text")).cast("bigint").alias("text_bytes"))


def request_rows(
    weights: DataFrame, job_id: int, max_tokens: int, requests_per_batch: int,
    resume: OpenBin | None = None, **packing,
) -> DataFrame:
    """Manifest: one narrow row per text.

    ``weights`` is the result of ``weigh_texts``. Gives ``job_id, batch_id,
    request_id, custom_id, pos, row_idx, token_count, text_bytes``; ``pos``
    counts from 0 inside the request. With ``resume`` the texts go on in the last
    request of an earlier manifest.
    """
    packed = pack_next_fit(weights, "row_idx", "token_count", max_tokens, extra=["text_bytes"],
                           bin_name="request_id", resume=resume, **packing)
    there = F.when(F.col("request_id") == resume.number, resume.items).otherwise(0) if resume else F.lit(0)
    within = Window.partitionBy("request_id").orderBy("row_idx")
    job = F.lit(job_id).cast("bigint")
    batch = chunk_id("request_id", requests_per_batch)
    return packed.select(
        job.alias("job_id"), batch.alias("batch_id"), "request_id",
        naming.custom_id(job, batch, F.col("request_id")).alias("custom_id"),
        (F.row_number().over(within) - 1 + there).alias("pos"), "row_idx", "token_count", "text_bytes",
    )


def request_totals(manifest: DataFrame, model: str) -> DataFrame:
    """Texts, tokens and line size per request."""
    return (
        manifest.groupBy("job_id", "batch_id", "request_id", "custom_id").agg(
            F.count(F.lit(1)).alias("text_count"), F.sum("token_count").alias("token_count"),
            F.min("row_idx").alias("first_row"), F.max("row_idx").alias("last_row"),
            F.sum("text_bytes").alias("text_bytes"))
        .withColumn("line_bytes", _line_bytes(
            F.col("custom_id"), model, F.col("text_bytes"), F.col("text_count")))
        .drop("text_bytes"))


def batch_totals(requests: DataFrame) -> DataFrame:
    """Requests, texts and tokens per batch."""
    return requests.groupBy("job_id", "batch_id").agg(
        F.count(F.lit(1)).alias("request_count"), F.sum("text_count").alias("text_count"),
        F.sum("token_count").alias("token_count"))


# --- files ------------------------------------------------------------------------

def roll_files(requests: DataFrame, max_bytes: int, **packing) -> DataFrame:
    """File of every request: a batch starts its next file when a line would pass the limit.

    Gives ``job_id, batch_id, request_id, line_bytes, file_no``.
    """
    packed = pack_next_fit(requests, "request_id", "line_bytes", max_bytes,
                           by=["job_id", "batch_id"], bin_name="file_no", **packing)
    return packed.withColumn("file_no", F.col("file_no") - 1)


def file_totals(rolled: DataFrame, model: str) -> DataFrame:
    """Requests and bytes per file, with the file's name."""
    return (
        rolled.groupBy(*FILE_KEYS)
        .agg(F.count(F.lit(1)).alias("request_count"), F.sum("line_bytes").alias("file_bytes"))
        .withColumn("file_name", naming.batch_file_name(
            F.lit(model), F.col("job_id"), F.col("batch_id"), F.col("file_no")))
    )


def _intervals(manifest: DataFrame, rolled: DataFrame) -> DataFrame:
    """Requests as intervals of ``row_idx`` with their file; they don't overlap."""
    requests = manifest.groupBy("job_id", "batch_id", "request_id", "custom_id").agg(
        F.min("row_idx").alias("first_row"), F.max("row_idx").alias("last_row"))
    return requests.join(rolled.select(*FILE_KEYS, "request_id"), ["job_id", "batch_id", "request_id"])


def file_of_rows(rows: DataFrame, intervals: DataFrame) -> DataFrame:
    """Range join: adds the file whose requests cover a row's ``row_idx``; other rows go.

    Files are intervals of row numbers. They are cut at the borders of buckets as
    wide as a file is on average, so a row meets the few intervals of its bucket,
    at most two cuts per file in all. Up to ``MAX_CUTS`` cuts are broadcast, with
    which the rows stay where they are; beyond it they are shuffled by bucket.
    """
    files = stage(intervals.groupBy(*FILE_KEYS).agg(
        F.min("first_row").alias("_first"), F.max("last_row").alias("_last")), "file-intervals")
    totals = files.agg(F.count(F.lit(1)), F.min("_first"), F.max("_last")).first()
    width = max(1, -(-((totals[2] or 0) - (totals[1] or 0) + 1) // max(1, totals[0])))

    def bucket(row: str) -> Column:
        return F.call_function("div", F.col(row), F.lit(width))

    cuts = files.withColumn("_bucket", F.explode(F.sequence(bucket("_first"), bucket("_last"))))
    cuts = F.broadcast(cuts) if 2 * totals[0] <= MAX_CUTS else cuts.hint("merge")
    inside = (F.col("_row_bucket") == F.col("_bucket")) & F.col("row_idx").between(F.col("_first"), F.col("_last"))
    return rows.withColumn("_row_bucket", bucket("row_idx")).join(cuts, inside).drop(
        "_bucket", "_row_bucket", "_first", "_last")


def request_lines(texts: DataFrame, manifest: DataFrame, rolled: DataFrame, model: str) -> DataFrame:
    """``job_id, batch_id, file_no, request_id, custom_id, line``: one JSON line per request.

    A text finds its file by a range join and is shuffled once, to its file. There
    the texts and one mark per request are put in the order of row numbers, and a
    text belongs to the last mark before it. A request is bounded by the token
    budget and a file by the byte budget.
    """
    intervals = stage(_intervals(manifest, rolled), "request-intervals")
    # Texts that no request covers lie outside all intervals or carry no text.
    literals = texts.filter(F.col("text").isNotNull()).select(
        "row_idx", json_string(F.col("text")).alias("literal"))
    placed = file_of_rows(literals, intervals).withColumns(
        {"request_id": F.lit(None).cast("bigint"), "custom_id": F.lit(None).cast("string"), "last_row": F.lit(None).cast("bigint")})
    marks = intervals.select(
        F.col("first_row").alias("row_idx"), F.lit(None).cast("string").alias("literal"), *FILE_KEYS,
        "request_id", "custom_id", "last_row")
    both = placed.unionByName(marks).repartition(*FILE_KEYS)
    before = Window.partitionBy(*FILE_KEYS).orderBy("row_idx", F.col("literal").isNotNull()).rowsBetween(
        Window.unboundedPreceding, 0)
    told = both.withColumns({c: F.last(c, True).over(before) for c in ("request_id", "custom_id", "last_row")}).filter(
        F.col("literal").isNotNull() & (F.col("row_idx") <= F.col("last_row")))
    in_order = F.array_sort(F.collect_list(F.struct("row_idx", "literal")))
    inputs = F.array_join(F.transform(in_order, lambda x: x["literal"]), ", ")
    return (
        told.groupBy(*FILE_KEYS, "request_id", "custom_id").agg(inputs.alias("inputs"))
        .select(*FILE_KEYS, "request_id", "custom_id",
                _line(F.col("custom_id"), model, F.col("inputs")).alias("line"))
    )
