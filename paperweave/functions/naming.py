"""Identifiers, file names and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_pad(number: Column, width: int) -> Column:
    """Left-pad with zeros; a longer number keeps all its digits."""
    return F.format_string(f"%0{width}d", number)


def custom_id(job_id: Column, batch_id: Column, request_id: Column) -> Column:
    return F.format_string("batch-%04d-%05d-request-%06d", job_id, batch_id, request_id)


def model_slug(model: Column) -> Column:
    return F.lower(F.substring_index(model, "/", -1))


def batch_file_name(model: Column, job_id: Column, batch_id: Column, file_no: Column) -> Column:
    """'<slug>-0001-batch-0002.jsonl', with '_1', '_2' … for later files of a batch."""
    suffix = F.when(file_no > 0, F.concat(F.lit("_"), file_no.cast("string"))).otherwise("")
    return F.concat(
        model_slug(model), F.format_string("-%04d-batch-%04d", job_id, batch_id),
        suffix, F.lit(".jsonl"),
    )


def file_stem(path: Column) -> Column:
    """File name without folders and last suffix."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"(?<=.)\.[^.]*\z", "")


def result_file_name(path: Column) -> Column:
    """Path of the result file that belongs to a request file."""
    folder = F.regexp_extract(path, r"\A(.*/)?", 0)
    return F.concat(folder, file_stem(path), F.lit("_result.jsonl"))


def drop_last_parts(text: Column, parts: int = 2, separator: str = "-") -> Column:
    """Text without its last ``parts`` separated parts."""
    pieces = F.split(text, separator, -1)
    keep = F.greatest(F.size(pieces) - F.lit(parts), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), keep), separator)


def display_time(moment: Column) -> Column:
    return F.date_format(moment, "dd/MM/yyyy, HH:mm:ss")


def or_null_word(text: Column) -> Column:
    """'Null' in place of a null or empty text."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("Null"))


def unix_time(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def as_utc(moment: Column) -> Column:
    """A time without zone is read as UTC."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), moment).cast("timestamp")
