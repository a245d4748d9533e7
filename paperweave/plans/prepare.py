"""Job 2: clean papers to request files and their manifest."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperweave import schemas
from paperweave.functions import naming, text as rules
from paperweave.functions.tokens import token_count
from paperweave.operators import requests
from paperweave.operators.packing import OpenBin, open_bin
from paperweave.sources import commits, landing
from paperweave.sources.state_tables import create_job
from paperweave.workspace import stage

MANIFEST = {"job_id": "bigint", "batch_id": "bigint", "request_id": "bigint", "custom_id": "string", "pos": "int",
            "row_idx": "bigint", "token_count": "bigint", "text_bytes": "bigint"}


@dataclass(frozen=True)
class Limits:
    max_input_tokens: int = schemas.MAX_INPUT_TOKENS
    max_requests_per_batch: int = schemas.MAX_REQUESTS_PER_BATCH
    max_batch_file_bytes: int = schemas.MAX_BATCH_FILE_BYTES


@dataclass(frozen=True)
class Prepared:
    manifest: DataFrame  # one row per text
    requests: DataFrame  # one row per request
    batches: DataFrame   # one row per batch
    files: DataFrame     # one row per file, with the path under which it landed
    rejects: DataFrame   # rows without text


def texts_of(papers: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """``row_idx, text``: one column as it is, or several joined by blank lines."""
    text = F.col(columns) if isinstance(columns, str) else rules.concat_fields(*map(F.col, columns))
    return papers.select("row_idx", text.alias("text"))


def _log(path: str) -> str:
    return f"{path}/packing"


def _stored(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and content of the last entry: ``parts`` of the manifest, ``open`` request and ``unlanded`` batch.

    ``unlanded`` is the first batch whose files don't hold the manifest yet, None once all do.
    """
    log = commits.read_log(spark, _log(path))
    return (max(log), log[max(log)]) if log else (0, {"parts": [], "open": None, "unlanded": None})


def _manifest(spark: SparkSession, path: str, parts: Sequence[str]) -> DataFrame:
    schema = ", ".join(f"{name} {kind}" for name, kind in MANIFEST.items())
    return spark.read.schema(schema).parquet(*[f"{path}/manifest/{part}" for part in parts])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of a prepared job, with all papers that it was extended by."""
    parts = _stored(spark, path)[1]["parts"]
    if not parts:
        raise FileNotFoundError(f"no manifest below {path}")
    return _manifest(spark, path, parts)


def _write_part(texts: DataFrame, job_id: int, path: str, limits: Limits, count: Callable[[Column], Column],
                before: OpenBin | None) -> tuple[str, OpenBin | None]:
    """Write the manifest of texts that go on after ``before``; gives its name and where the packing stands."""
    part = uuid.uuid4().hex
    rows = requests.request_rows(requests.weigh_texts(texts, count), job_id, limits.max_input_tokens,
                                 limits.max_requests_per_batch, resume=before)
    rows.select(*[F.col(name).cast(kind) for name, kind in MANIFEST.items()]).write.parquet(f"{path}/manifest/{part}")
    now = open_bin(_manifest(texts.sparkSession, path, [part]), "row_idx", "token_count", "request_id")
    if now is None:
        return part, before
    if before is not None and now.number == before.number:
        now = OpenBin(now.number, now.weight + before.weight, now.items + before.items, now.last)
    return part, now


def _land(texts: DataFrame, manifest: DataFrame, model: str, path: str, limits: Limits, batch: int | None = None) -> None:
    """Land the files of all batches, or of those from ``batch`` on beside the others' files."""
    if batch is not None:
        manifest = manifest.filter(F.col("batch_id") >= batch)
        least = manifest.agg(F.min("row_idx")).first()[0]
        texts = texts.filter(F.col("row_idx") >= (least or 0))
        if manifest.join(texts.filter(F.col("text").isNotNull()), "row_idx", "left_anti").take(1):
            raise ValueError("the papers lack rows that the job has packed; extend it with all papers")
    rolled = stage(requests.roll_files(requests.request_totals(manifest, model), limits.max_batch_file_bytes), "files")
    name = naming.batch_file_name(F.lit(model), F.col("job_id"), F.col("batch_id"), F.col("file_no"))
    lines = requests.request_lines(texts, manifest, rolled, model).withColumn("file_name", name)
    landing.land_lines(lines, f"{path}/files", "request_id", keep=batch is not None)


def _prepared(texts: DataFrame, manifest: DataFrame, model: str, path: str) -> Prepared:
    per_request = requests.request_totals(manifest, model)
    landed = landing.landed_files(texts.sparkSession, f"{path}/files").select("file_name", "path", "file_bytes", "n_lines")
    # Names tell job, batch and file number; what has landed is what counts.
    number = F.regexp_extract("file_name", r"-(\d+)-batch-(\d+)(?:_(\d+))?\.jsonl$", 1).cast("bigint")
    batch = F.regexp_extract("file_name", r"-batch-(\d+)(?:_(\d+))?\.jsonl$", 1).cast("bigint")
    file_no = F.coalesce(F.nullif(F.regexp_extract("file_name", r"_(\d+)\.jsonl$", 1), F.lit("")), F.lit("0")).cast("bigint")
    files = landed.select(number.alias("job_id"), batch.alias("batch_id"), file_no.alias("file_no"),
                          F.col("n_lines").alias("request_count"), "file_bytes", "file_name", "path")
    return Prepared(manifest, per_request, requests.batch_totals(per_request), files,
                    texts.filter(F.col("text").isNull()).select("row_idx"))


def run(
    papers: DataFrame, columns: str | Sequence[str], model: str, job_id: int, path: str,
    limits: Limits = Limits(), count: Callable[[Column], Column] = token_count,
) -> Prepared:
    """Pack texts, land request files below ``path/files`` and write the manifest beside them."""
    schemas.model_dimension(model)
    spark, texts = papers.sparkSession, texts_of(papers, columns)
    number, _ = _stored(spark, path)
    part, now = _write_part(texts, job_id, path, limits, count, None)
    manifest = _manifest(spark, path, [part])
    _land(texts, manifest, model, path, limits)
    entry = {"parts": [part], "open": now and asdict(now), "unlanded": None}
    if not commits.try_append(spark, _log(path), number + 1, entry):
        raise commits.Conflict(f"another run prepared {path}")
    return _prepared(texts, manifest, model, path)


def extend(
    papers: DataFrame, columns: str | Sequence[str], model: str, job_id: int, path: str,
    limits: Limits = Limits(), count: Callable[[Column], Column] = token_count, sealed: bool = False,
) -> Prepared:
    """Add papers to a prepared job; the result is that of one run over all of them.

    ``papers`` holds all papers, old and new; those numbered behind the last packed
    one are new, and only they are weighed. They go on in the last request, so the
    files of its batch are written again; earlier files stay. With ``sealed``, for files
    that were sent already, they begin a batch of their own instead.

    A broken call can be repeated: what it had packed is landed then. Of two calls at
    once, one packs behind the other; one whose papers lack what the other packed is
    an error, and the next call with all papers lands the files.
    """
    schemas.model_dimension(model)
    spark, texts = papers.sparkSession, texts_of(papers, columns)
    seen = commits.read_log(spark, _log(path))
    if not seen:
        raise FileNotFoundError(f"no prepared job below {path}")
    per_batch = limits.max_requests_per_batch

    def work(log: dict[int, dict]) -> dict:
        old = log[max(log)]
        before = OpenBin(**old["open"]) if old["open"] else None
        if before is not None and sealed:
            full = -(-before.number // per_batch) * per_batch
            before = OpenBin(full, limits.max_input_tokens + 1, 0, before.last)
        fresh = texts.filter(F.col("row_idx") > before.last) if before else texts
        part, now = _write_part(fresh, job_id, path, limits, count, before)
        if now == before:
            return {**old, "parts": [*old["parts"], part]}
        first = 1 if before is None else (before.number // per_batch if sealed else (before.number - 1) // per_batch) + 1
        return {"parts": [*old["parts"], part], "open": asdict(now),
                "unlanded": min(first, old["unlanded"] or first)}

    number, entry = commits.commit(spark, _log(path), seen, work, lambda mine, other: True)
    mine = entry["unlanded"]
    # Files are written from the last entry; if another came meanwhile, they are written again from that one.
    while mine is not None:
        _land(texts, _manifest(spark, path, entry["parts"]), model, path, limits, mine)
        if commits.try_append(spark, _log(path), number + 1, {**entry, "unlanded": None}):
            break
        # Said in the log first, so that it isn't lost if this call breaks.
        number, entry = commits.commit(
            spark, _log(path), commits.read_log(spark, _log(path)),
            lambda log: {**log[max(log)], "unlanded": min(mine, log[max(log)]["unlanded"] or mine)}, lambda a, b: True)
        mine = entry["unlanded"]
    return _prepared(texts, _manifest(spark, path, entry["parts"]), model, path)


def run_new_job(
    papers: DataFrame, columns: str | Sequence[str], model: str, state_root: str, path: str,
    limits: Limits = Limits(), count: Callable[[Column], Column] = token_count,
) -> tuple[int, Prepared]:
    """Create a job, then prepare its requests below ``path/<job id>``."""
    schemas.model_dimension(model)
    job_id = create_job(papers.sparkSession, state_root, model)
    return job_id, run(papers, columns, model, job_id, f"{path}/{job_id:04}", limits, count)
