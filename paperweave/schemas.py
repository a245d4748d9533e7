"""Table shapes and the fixed values that go with them."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------

# Subject classes kept by the cleaning job.
SUBJECTS = ["cs.AI", "cs.CG", "cs.CL", "cs.CV", "cs.IR", "cs.LG", "cs.MA", "cs.NE", "cs.RO"]

# Vector width per embedding model.
MODEL_DIMENSIONS = {"Qwen/Qwen3-Embedding-8B": 4096}

# Request limits.
MAX_INPUT_TOKENS = 200_000
MAX_REQUESTS_PER_BATCH = 50_000
MAX_BATCH_FILE_BYTES = 200 * 1024 * 1024

# Collection load sizes.
LOAD_CHUNK_ROWS = 10_000
UPLOAD_BATCH_ROWS = 256

JOB_STATUSES = ["pending", "processing", "completed", "failed"]
BATCH_STATUSES = [
    "validating", "validated", "in_progress", "finalizing", "completed",
    "failed", "expired", "cancelled", "cancelling",
]

# Names and order of the fields below are fixed values of the data formats.

# --- raw and clean papers ---------------------------------------------------

RAW_PAPERS = T.StructType(
    [T.StructField(name, T.StringType()) for name in (
        "id", "submitter", "authors", "title", "comments", "journal-ref", "doi",
        "report-no", "categories", "license", "abstract")]
    + [
        T.StructField("versions", T.ArrayType(T.StructType([
            T.StructField("version", T.StringType()),
            T.StructField("created", T.StringType())]))),
        T.StructField("update_date", T.StringType()),
        T.StructField("authors_parsed", T.ArrayType(T.ArrayType(T.StringType()))),
    ]
)

CLEAN_COLUMNS = [
    "id", "doi", "title", "abstract", "authors_parsed", "categories_parsed",
    "journal-ref", "license", "last_submitted",
]

# --- result lines and snapshots ---------------------------------------------

_DATA = "array<struct<embedding:array<float>>>"
RESULT_LINE = {
    "response.data": f"custom_id string, response struct<data:{_DATA}>",
    "response.body.data": f"custom_id string, response struct<body:struct<data:{_DATA}>>",
}

BATCH_TIMES = [
    "created_at", "cancelled_at", "cancelling_at", "completed_at", "expired_at",
    "expires_at", "failed_at", "finalizing_at", "in_progress_at",
]
# A batch's last change looks at every time but the planned expiry.
CHANGE_TIMES = [name for name in BATCH_TIMES if name != "expires_at"]

SNAPSHOT_DDL = (
    "id string, completion_window string, endpoint string, object string, status string, "
    "input_file_id string, output_file_id string, error_file_id string, "
    "request_counts struct<completed:int,failed:int,total:int>, usage string, errors string, "
    + ", ".join(f"{name} bigint" for name in BATCH_TIMES)
)

# Columns a snapshot may change on a stored batch.
UPDATABLE = (
    ["status", "output_file_id", "error_file_id", "request_completed", "request_failed",
     "request_total", "usage", "errors"]
    + [name for name in BATCH_TIMES if name != "created_at"]
)

# --- state tables -----------------------------------------------------------

JOBS_DDL = (
    "id bigint, status string, model string, created_at timestamp, "
    "updated_at timestamp, finished_at timestamp"
)
BATCHES_DDL = (
    "id bigint, job_id bigint, batch_oaid string, completion_window string, endpoint string, "
    "object string, status string, input_file_id string, local_file_id string, "
    "output_file_id string, error_file_id string, request_completed int, request_failed int, "
    "request_total int, usage string, errors string, "
    + ", ".join(f"{name} timestamp" for name in BATCH_TIMES)
    + ", output_file_local string, loaded_to_qdrant int, loaded_at timestamp"
)
STATE_DDL = {"jobs": JOBS_DDL, "batches": BATCHES_DDL}

REQUIRED = {
    "jobs": ["id", "status", "model"],
    "batches": ["id", "job_id", "batch_oaid", "completion_window", "endpoint", "object",
                "status", "input_file_id", "local_file_id", "created_at"],
}


def model_dimension(model: str) -> int:
    """Width of a model's vectors; an unknown model is an error."""
    if model not in MODEL_DIMENSIONS:
        raise ValueError(f"unknown model {model!r}; known: {sorted(MODEL_DIMENSIONS)}")
    return MODEL_DIMENSIONS[model]
