"""Product codes of vectors, assigned through memoised grid cells.

Components become whole numbers, floor(256 x); a vector is cut into equal parts
and every part position has a codebook. To assign a part, its coarse grid cell is
hashed. For a cell met the first time the smallest and largest distance of every
entry to the cell's box are worked out, and only entries whose smallest distance
does not exceed the least of the largest ones are kept: the others are farther
than some entry wherever in the box the part lies. The memo keeps these short lists
per task; only they are evaluated exactly, on whole numbers.

A round of learning is one scan: tasks add up their parts per entry, a table of
fixed size (entries x dimensions) is summed over the tasks and read by the driver.

Defined results: rows whose vector is null or holds null or non-finite components
take no part, nor do rows whose vector has another length than the first kept
one's. Codebooks start from the smallest ids, nulls last, repeated ids by their
vector; with fewer rows they are shorter. Ties go to the lower entry. Repeated
rows are coded alike and count as often as they occur. An empty table gives an
empty one. Lengths that the parts don't divide, and components so large that exact
sums would pass 64 bits, are errors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperweave.llm.common import need, quoted
from paperweave.workspace import stage

SCALE, PARTS, ENTRIES, ROUNDS = 256.0, 16, 64, 2
CELLS = 8  # a codebook's range of values is cut into about so many cells per component
MEMO = 1 << 16  # cells a task remembers per part
SLICE = 4096
HOT_ROWS = 10_000
_OUT = "id {0}, label {1}, code string, error bigint"


def kept_vectors(rows: DataFrame, id_column: str, vector: str, label: str | None) -> DataFrame:
    """(id, label, v) of the rows that take part."""
    need(rows, id_column, vector, *([label] if label else []))
    x = quoted(vector)
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    largest = F.array_max(F.transform(x, lambda c: F.abs(c.cast("double"))))
    bound = (1 << 24) / SCALE  # squared distances of 8,192 components then stay below 2 ** 63
    checked = F.when(largest > bound, F.raise_error(F.lit(f"a vector component is beyond {bound}"))).otherwise(
        F.transform(x, lambda c: F.floor(F.lit(SCALE) * c.cast("double")).cast("int")))
    return rows.filter(x.isNotNull() & ~odd).select(
        quoted(id_column).alias("id"), (quoted(label) if label else F.lit(None).cast("int")).alias("label"), checked.alias("v"))


class Grid:
    """One part's codebook with its memo."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        spread = int(entries.max(initial=0)) - int(entries.min(initial=0))
        self.width = max(1, spread // CELLS)
        self.memo: dict[bytes, np.ndarray] = {}
        self.weights = np.random.default_rng(1).integers(1, 1 << 62, entries.shape[1], np.uint64) | np.uint64(1)

    def not_dominated(self, cells: np.ndarray) -> list[np.ndarray]:
        """Per cell, the entries that are nearest to some point of its box."""
        low = (cells * self.width)[:, None, :]
        high = low + self.width - 1
        e = self.entries[None, :, :]
        nearest = (np.maximum(np.maximum(low - e, e - high), 0) ** 2).sum(axis=2)
        farthest = (np.maximum(np.abs(e - low), np.abs(e - high)) ** 2).sum(axis=2)
        return [np.flatnonzero(row) for row in nearest <= farthest.min(axis=1)[:, None]]

    def lists(self, cells: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """The lists of the distinct cells, and which one each row's cell is."""
        hashes = (cells.astype(np.uint64) * self.weights).sum(axis=1, dtype=np.uint64)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if not (cells[first][which] == cells).all():  # two cells with one hash
            _, first, which = np.unique(cells, axis=0, return_index=True, return_inverse=True)
        keys = [cells[i].tobytes() for i in first]
        new = [n for n, key in enumerate(keys) if key not in self.memo]
        if new:
            if len(self.memo) + len(new) > MEMO:
                self.memo.clear()
                new = range(len(keys))
            self.memo.update((keys[n], found) for n, found in zip(new, self.not_dominated(cells[first[list(new)]])))
        return [self.memo[key] for key in keys], which.reshape(-1)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of every row."""
        lists, which = self.lists(x // self.width)
        sizes = np.array([len(found) for found in lists])
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        of_row = sizes[which]
        begins = np.r_[0, np.cumsum(of_row)[:-1]]
        row = np.repeat(np.arange(len(x)), of_row)
        entry = np.concatenate(lists)[np.arange(len(row)) - begins[row] + starts[which][row]]
        distance = ((x[row] - self.entries[entry]) ** 2).sum(axis=1)
        best = np.minimum.reduceat(distance, begins)
        # Lists are in the order of entries, so the lowest of equally near ones wins.
        return np.minimum.reduceat(np.where(distance == best[row], entry, len(self.entries)), begins), best


def _slices(batches: Iterator[pa.RecordBatch], column: int, dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            yield part, part.column(column).flatten().to_numpy().reshape(-1, dim).astype(np.int64)


def _sums(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, at, n, total) over all vectors: how many parts an entry has, and their sums."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [Grid(book) for book in books]
        n, total = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for _, x in _slices(batches, 0, parts * width):
            for p, grid in enumerate(grids):
                mine = x[:, p * width:(p + 1) * width]
                entry, _ = grid.assign(mine)
                n[p] += np.bincount(entry, minlength=entries)
                np.add.at(total[p], entry, mine)
        p, e, at = (i.reshape(-1) for i in np.indices(books.shape))
        columns = [p, e, at, np.repeat(n.reshape(-1), width), total.reshape(-1)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "at", "n", "total"])

    rows = vectors.select("v").mapInArrow(run, "part bigint, entry bigint, at bigint, n bigint, total bigint")
    return rows.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def learn_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (part, entry, component) learned from (id, v); None where there are no vectors.

    What comes to the driver has ``entries`` x dimensions numbers, whatever the input.
    """
    start = vectors.orderBy(F.col("id").asc_nulls_last(), "v").limit(1).collect()
    if not start:
        return None
    dim = len(start[0]["v"])
    if not dim or dim % parts:
        raise ValueError(f"vectors of {dim} components can't be cut into {parts} equal parts")
    alike = vectors.filter(F.size("v") == dim)
    first = alike.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, dim // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        for r in _sums(alike, books).filter("n > 0").collect():
            books[r["part"], r["entry"], r["at"]] = r["total"] // r["n"]
    return books


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, label, code, error): entries of all parts in order, two hex digits each, and the squared distances' sum."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [Grid(book) for book in books]
        for rows, x in _slices(batches, 2, parts * width):
            codes, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for p, grid in enumerate(grids):
                entry, distance = grid.assign(x[:, p * width:(p + 1) * width])
                codes[:, p] = entry
                error += distance
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array([c.tobytes().hex() for c in codes]), pa.array(error)],
                ["id", "label", "code", "error"])

    types = [vectors.schema[c].dataType.simpleString() for c in ("id", "label")]
    return vectors.filter(F.size("v") == parts * width).select("id", "label", "v").mapInArrow(run, _OUT.format(*types))


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``, the error summed over equal labels, nulls together.

    Labels of many rows are few, ``HOT_ROWS`` at most of a table of any size, so their
    sums are broadcast; rows of the other labels are joined by a shuffle.
    """
    sums = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_n")), "label-errors")
    rows = sums.agg(F.sum("_n")).first()[0] or 0
    many = max(HOT_ROWS, rows // HOT_ROWS)
    hot = sums.filter(F.col("_n") > many).select(F.col("label").alias("_hot"), F.col("label_error").alias("_hot_error"), F.lit(True).alias("_is_hot"))
    rest = sums.filter(F.col("_n") <= many).select(F.col("label").alias("_rest"), "label_error")
    found = coded.join(F.broadcast(hot), F.col("label").eqNullSafe(F.col("_hot")), "left")
    of_hot = found.filter("_is_hot").select(*coded.columns, F.col("_hot_error").alias("label_error"))
    of_rest = found.filter("_is_hot is null").join(rest.hint("merge"), F.col("label").eqNullSafe(F.col("_rest"))).select(
        *coded.columns, "label_error")
    return of_hot.unionByName(of_rest)


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(
    rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str | None = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) of every vector that takes part."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte per part, so 1 to 256 entries")
    vectors = stage(kept_vectors(rows, id_column, vector, label), "whole-vectors")
    books = learn_codebooks(vectors, parts, entries, rounds)
    if books is None:
        return vectors.select("id", "label", F.lit("").alias("code"), *[
            F.lit(0).cast("bigint").alias(c) for c in ("error", "label_error")], F.lit("").alias("codebooks_sha256"))
    coded = stage(encode(vectors, books), "codes")
    return with_label_error(coded).withColumn("codebooks_sha256", F.lit(digest(books)))
