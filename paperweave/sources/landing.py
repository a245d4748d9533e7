"""Files that land under names of their own, all visible at once.

A Spark data source writes rows (file_name, line), grouped by file, from the tasks.
Every attempt of a task writes below a folder of its own, so a task that runs
again or twice disturbs nothing. Its commit message lists what it wrote; the
job's commit checks that no file came from two tasks and then writes the listing,
one small file that makes all of them visible. What no listing names has not
landed. The last listing of a folder counts; a write that keeps what has landed
lists the earlier files too, other than those it wrote again.

Request files go out this way, and result files are found by the names that
belong to the stored batches.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from paperweave.functions import naming

FORMAT = "paperweave_landing"
LISTINGS = "_landed"
LISTED = "file_name string, path string, file_bytes bigint, n_lines bigint"


@dataclass
class Written(WriterCommitMessage):
    folder: str
    files: list[tuple[str, str, int, int]]  # name, path, bytes, lines


class LandingWriter(DataSourceArrowWriter):
    def __init__(self, root: str, keep: bool = False) -> None:
        self.keep = keep
        self.root, self.run = root.rstrip("/"), f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"

    def _at(self, *parts: str) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri("/".join([self.root, *parts]))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One file after the other; rows of a file come together."""
        folder = f"run={self.run}/{uuid.uuid4().hex}"
        files, at = self._at(folder)
        done: list[tuple[str, str, int, int]] = []
        begun: set[str] = set()
        name, out, size, lines = None, None, 0, 0

        def close() -> None:
            if out is not None:
                out.close()
                done.append((name, f"{self.root}/{folder}/{name}", size, lines))

        for batch in iterator:
            for given, line in zip(batch.column(0), batch.column(1)):
                given = given.as_py()
                if given != name:
                    close()
                    if given in begun or "/" in given or not given:
                        raise ValueError(f"file {given!r} is not one run of rows with a plain name")
                    begun.add(given)
                    files.create_dir(at, recursive=True)
                    name, out, size, lines = given, files.open_output_stream(f"{at}/{given}", compression=None), 0, 0
                data = line.as_py().encode() + b"\n"
                out.write(data)
                size, lines = size + len(data), lines + 1
        close()
        return Written(folder, done)

    def commit(self, messages: list[Written | None]) -> None:
        written = [m for m in messages if m is not None]
        names = [f[0] for m in written for f in m.files]
        if len(set(names)) < len(names):
            raise ValueError("a file was written by several tasks")
        files, at = self._at(f"run={self.run}")
        kept = {m.folder.rpartition("/")[2] for m in written}
        for found in files.get_file_info(pafs.FileSelector(at, allow_not_found=True)):
            if found.base_name not in kept:  # of attempts that did not count
                files.delete_dir(found.path)
        _, listings = self._at(LISTINGS)
        files.create_dir(listings, recursive=True)
        earlier = max((f.path for f in files.get_file_info(pafs.FileSelector(listings))
                       if f.base_name.endswith(".jsonl")), default=None) if self.keep else None
        again = set(names)
        with files.open_output_stream(f"{listings}/_{self.run}", compression=None) as out:
            if earlier is not None:
                with files.open_input_stream(earlier, compression=None) as old:
                    for row in old.read().splitlines(keepends=True):  # a row per file
                        if json.loads(row)["file_name"] not in again:
                            out.write(row)
            for m in written:
                for f in m.files:
                    out.write((json.dumps(dict(zip(("file_name", "path", "file_bytes", "n_lines"), f))) + "\n").encode())
        files.move(f"{listings}/_{self.run}", f"{listings}/{self.run}.jsonl")

    def abort(self, messages: list[Written | None]) -> None:
        files, at = self._at(f"run={self.run}")
        if files.get_file_info(at).type == pafs.FileType.Directory:
            files.delete_dir(at)


class Landing(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> LandingWriter:
        return LandingWriter(self.options["path"], self.options.get("keep") == "true")


def _uri(spark: SparkSession, root: str) -> str:
    """The folder with its scheme, as Spark's default file system resolves it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def land_lines(lines: DataFrame, root: str, order: str, name: str = "file_name", line: str = "line",
               keep: bool = False) -> None:
    """Write the lines of every file, in ``order``; ``lines`` must be dealt out so that a file is in one partition.

    With ``keep`` the files of earlier writes stay, other than those of the same name.
    """
    spark = lines.sparkSession
    spark.dataSource.register(Landing)
    lines.sortWithinPartitions(name, order).select(
        F.col(name).alias("file_name"), F.col(line).alias("line")).write.format(FORMAT).option(
        "path", _uri(spark, root)).option("keep", str(keep).lower()).mode("append").save()


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """``file_name, path, file_bytes, n_lines`` of what has landed; one row per file."""
    try:
        listings = spark.read.text(f"{root}/{LISTINGS}").select(F.col("_metadata.file_path").alias("p")).agg(F.max("p")).first()[0]
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition()):
            raise
        listings = None
    if listings is None:
        return spark.createDataFrame([], LISTED)
    return spark.read.schema(LISTED).json(listings)


def stored_sizes(spark: SparkSession, root: str) -> DataFrame:
    """``file_name, stored_bytes`` as the file system has them, of all files below the folder; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return found.select(F.substring_index("path", "/", -1).alias("file_name"), F.col("length").alias("stored_bytes"))


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    """``file_name, value`` of every landed line; files that no listing names are left out."""
    landed = landed_files(spark, root)
    # Attempts have names of their own, so run, attempt and file name are enough to tell files apart.
    at = landed.select(F.substring_index("path", "/", -3).alias("_at"))
    runs = [r["run"] for r in landed.select(F.substring_index(
        F.substring_index("path", "/", -3), "/", 1).alias("run")).distinct().collect()]  # one per write into the folder
    if not runs:
        return spark.createDataFrame([], "file_name string, value string")
    lines = spark.read.option("recursiveFileLookup", "true").text([f"{root}/{run}" for run in runs]).select(
        F.col("_metadata.file_name").alias("file_name"), "value",
        F.regexp_replace(F.substring_index(F.col("_metadata.file_path"), "/", -3), "%3D", "=").alias("_at"))
    return lines.join(at, "_at", "left_semi").drop("_at")


def expected_results(batches: DataFrame) -> DataFrame:
    """``batch_oaid, result_name``: the result file that belongs to each stored batch's request file."""
    name = F.substring_index(naming.result_file_name(F.col("local_file_id")), "/", -1)
    return batches.filter(F.col("local_file_id").isNotNull()).select("job_id", "batch_oaid", name.alias("result_name"))


def result_lines(spark: SparkSession, batches: DataFrame, folder: str) -> DataFrame:
    """``value, source_file`` of the lines of the batches' result files below the folder; other files are left out."""
    names = expected_results(batches).select("result_name").distinct()
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*_result.jsonl").text(folder).select(
        "value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_name").alias("_name"))
    return lines.join(names, F.col("_name") == F.col("result_name"), "left_semi").drop("_name")


def missing_results(spark: SparkSession, batches: DataFrame, folder: str) -> DataFrame:
    """Expected result files that have not landed below the folder."""
    here = stored_sizes(spark, folder).select(F.col("file_name").alias("result_name"))
    return expected_results(batches).join(here, "result_name", "left_anti")
