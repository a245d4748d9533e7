"""Paper metadata: NDJSON in, Parquet out."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperweave.schemas import RAW_PAPERS

# Where a row stands in its source, in reading order.
POSITION = ["_file", "_block", "_line"]


def require_suffix(path: str, suffix: str) -> str:
    """The path itself; a file name with another suffix is an error."""
    found = PurePosixPath(path).suffix
    if found not in ("", suffix):
        raise ValueError(f"expected a {suffix} path, got {path}")
    return path


def default_clean_path(source: str) -> str:
    """'<folder>/<stem>-clean.parquet' beside the source."""
    # Text work only: a path object would fold the slashes of a URI.
    folder, slash, name = source.rstrip("/").rpartition("/")
    stem = name.rpartition(".")[0] or name
    return f"{folder}{slash}{stem}-clean.parquet"


def read_raw_papers(
    spark: SparkSession, path: str, strict: bool = True, corrupt_column: str = "_corrupt",
) -> DataFrame:
    """Raw papers with the fixed schema: absent fields are null, others dropped.

    A malformed line is an error; with ``strict=False`` it is kept in
    ``corrupt_column`` with null fields.
    """
    require_suffix(path, ".json")
    schema, reader = RAW_PAPERS, spark.read.option("mode", "FAILFAST")
    if not strict:
        schema = T.StructType([*RAW_PAPERS.fields, T.StructField(corrupt_column, T.StringType())])
        reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).json(path)


def with_position(papers: DataFrame) -> DataFrame:
    """Add the ``POSITION`` columns; call it straight on a file scan."""
    return papers.select(
        "*", F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"))


def read_papers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(require_suffix(path, ".parquet"))


def write_papers(papers: DataFrame, path: str, mode: str = "overwrite") -> str:
    papers.write.mode(mode).option("compression", "zstd").parquet(require_suffix(path, ".parquet"))
    return path
