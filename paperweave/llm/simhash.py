"""Near-duplicates by SimHash, compared on vertical bit planes.

1. A task reads whole texts and writes one 64-bit fingerprint per row: a bit is
   set where more than half of the hashes of the word shingles have it.
2. Equal fingerprints become one node, so copies cost nothing further.
3. Fingerprints at most three bits apart agree on two of five bit ranges, so
   every node goes to ten tables, keyed by those ranges. Rows of a key lie side
   by side; a task turns them into bit planes and compares all rows with those
   a fixed distance further on, 64 to a machine word, by carry-save counters.
   Words in which every pair is beyond the radius are abandoned midway. A key
   with more than ``TILE`` rows is cut into tiles and every pair of tiles is a
   task of its own. A task gives a star per linked set and never its pairs.
4. Stars are joined to components by alternating large and small stars, each
   round written to the shared folder.

Defined results: a text without words (null, empty, blank) has fingerprint zero
and links like any other. Rows with the same id are all judged; a row whose id
is null gets the smallest id of its group, null if none has one. Repeated rows
and exact copies are one node. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperweave.llm.common import fresh, need, quoted
from paperweave.workspace import stage

SHINGLE, SEED, RADIUS = 3, 42, 3
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # first bit and width
SHARED = len(BLOCKS) - RADIUS  # so many ranges hold no differing bit
TILE = 2048
PIECE = 1 << 20
HASHES = 1 << 15
FIRST_PLANES = 20  # after so many planes most words can be abandoned
ROWS = 1 << 17

MASKS = [sum(((1 << w) - 1) << b for b, w in chosen) for chosen in combinations(BLOCKS, SHARED)]


def words_in_runs(text: str | None) -> Iterator[list[bytes]]:
    """The lower-case words in order, a run at a time, so that long texts stay small in memory."""
    data = (text or "").encode()
    at = 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield data[at:end].lower().split()
        at = end


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    import xxhash

    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    counts, total, held = np.zeros(64, np.int64), 0, []

    def add(shingles: Iterator[bytes]) -> None:
        nonlocal counts, total
        hashes = np.fromiter(map(digest, shingles), np.uint64)
        for i in range(0, len(hashes), HASHES):
            part = hashes[i:i + HASHES]
            bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)

    for run in words_in_runs(text):
        words = held + run
        if len(words) >= shingle:
            add(map(b" ".join, zip(*[words[i:] for i in range(shingle)])))
            words = words[-(shingle - 1):] if shingle > 1 else []
        held = words
    if not total and held:
        add(iter([b" ".join(held)]))
    bits = np.packbits((2 * counts > total).astype(np.uint8), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, ``fp`` as a signed long) of every row."""
    need(docs, id_column, text)
    rows = docs.select(quoted(id_column).cast("bigint").alias("id"), quoted(text).alias("text"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["id", "fp"])

    return rows.mapInArrow(of, "id bigint, fp bigint")


def planes_of(values: np.ndarray, bits: list[int]) -> np.ndarray:
    """Bit planes: row p holds bit ``bits[p]`` of every value, 64 values to a word, one spare word at the end."""
    padded = np.zeros((len(values) // 64 + 2) * 64, np.uint64)
    padded[:len(values)] = values
    made = np.packbits(((padded[None, :] >> np.array(bits, np.uint64)[:, None]) & np.uint64(1)).astype(np.uint8),
                       axis=1, bitorder="little")
    return made.view("<u8")


def shifted(planes: np.ndarray, by: int) -> np.ndarray:
    """The planes ``by`` values further on (less than the spare word allows is read as zero)."""
    words, rest = divmod(by, 64)
    out = np.zeros_like(planes)
    kept = planes.shape[-1] - words
    if kept <= 0:
        return out
    if not rest:
        out[..., :kept] = planes[..., words:]
        return out
    out[..., :kept] = planes[..., words:] >> np.uint64(rest)
    out[..., :kept - 1] |= planes[..., words + 1:] << np.uint64(64 - rest)
    return out


def within_radius(planes: np.ndarray, by: int, valid: np.ndarray) -> np.ndarray:
    """Mask of the values that differ from the one ``by`` further on in at most RADIUS = 3 planes."""
    other = shifted(planes, by)
    at = np.flatnonzero(valid)

    def count(first: int, last: int, words: np.ndarray, state: list[np.ndarray]) -> list[np.ndarray]:
        ones, twos, over = state
        for p in range(first, last):
            differs = planes[p][words] ^ other[p][words]
            carry = ones & differs
            ones = ones ^ differs
            over = over | (twos & carry)
            twos = twos ^ carry
        return [ones, twos, over]

    state = count(0, min(FIRST_PLANES, len(planes)), at, [np.zeros(len(at), np.uint64) for _ in range(3)])
    alive = (valid[at] & ~state[2]) != 0
    at, state = at[alive], [s[alive] for s in state]
    state = count(min(FIRST_PLANES, len(planes)), len(planes), at, state)
    out = np.zeros_like(valid)
    out[at] = valid[at] & ~state[2]
    return out


def packed(mask: np.ndarray) -> np.ndarray:
    padded = np.zeros((len(mask) // 64 + 2) * 64, np.uint8)
    padded[:len(mask)] = mask
    return np.packbits(padded, bitorder="little").view("<u8")


def unpacked(words: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(words.view(np.uint8), bitorder="little")[:n].astype(bool)


def stars(values: np.ndarray, runs: np.ndarray, mask: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, smallest value of its linked set) for linked values; equal ``runs`` lie side by side."""
    bits = [b for b in range(64) if not mask >> b & 1]
    order = np.lexsort((values, runs))
    values, runs = values[order], runs[order]
    root = np.arange(len(values))
    index = np.arange(len(values))  # rows of the runs still longer than the distance
    starts = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]]) if len(runs) else np.zeros(0, int)
    length = np.repeat(np.diff(np.r_[starts, len(runs)]), np.diff(np.r_[starts, len(runs)]))
    left, right = [], []
    by, planes, used = 1, None, 0
    while True:
        active = length[index] > by
        if not active.any():
            break
        if planes is None or active.sum() < 0.5 * used:
            index = index[active]
            planes, used = planes_of(values[index], bits), len(index)
        same = np.zeros(used, bool)
        if by < used:
            same[:-by] = runs[index[:-by]] == runs[index[by:]]
        found = np.flatnonzero(unpacked(within_radius(planes, by, packed(same)), used))
        if len(found):
            left.append(index[found])
            right.append(index[found + by])
            if sum(map(len, left)) > 4 * len(values):
                root = joined(root, np.concatenate(left), np.concatenate(right))
                left, right = [], []
        by += 1
    if left:
        root = joined(root, np.concatenate(left), np.concatenate(right))
    linked = np.zeros(len(values), bool)
    moved = root != np.arange(len(values))
    linked[moved] = True
    return values[linked], values[root[linked]]


def joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots (the smallest index) after linking a[i] with b[i]."""
    root = root.copy()
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        low, high = np.minimum(x, y), np.maximum(x, y)
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars from rows (table, key, tile pair, fp) that come sorted by all but the last."""
    held: list[np.ndarray] = []

    def solve(table: np.ndarray) -> Iterator[pa.RecordBatch]:
        for t in np.unique(table[0]):
            rows = table[:, table[0] == t]
            change = np.r_[True, (rows[1:3, 1:] != rows[1:3, :-1]).any(axis=0)]
            fp, low = stars(rows[3].view(np.uint64), np.cumsum(change), MASKS[int(t)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(fp.view(np.int64)), pa.array(low.view(np.int64))], ["a", "b"])

    for batch in batches:
        held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
        if sum(h.shape[1] for h in held) >= ROWS:
            table = np.concatenate(held, axis=1)
            change = np.flatnonzero((table[:3, 1:] != table[:3, :-1]).any(axis=0))
            if len(change):  # the last run may go on
                cut = change[-1] + 1
                yield from solve(table[:, :cut])
                held = [table[:, cut:]]
            else:
                held = [table]
    if held:
        table = np.concatenate(held, axis=1)
        if table.shape[1]:
            yield from solve(table)


def links(nodes: DataFrame) -> DataFrame:
    """Star edges (a, b) over distinct fingerprints ``fp`` that connect what lies within the radius."""
    def signed(mask: int) -> int:
        return mask - (1 << 64) if mask >> 63 else mask

    keyed = nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).cast("bigint").alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("k"))
        for t, m in enumerate(MASKS)])).alias("x")).select("x.t", "x.k", "fp")
    shared = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").withColumn(
        "tiles", F.ceil(F.col("n") / TILE).cast("int"))
    mine = F.pmod(F.xxhash64("fp", "t"), F.col("tiles")).cast("int")
    # A tile meets every tile of its key, itself included, once.
    pairs = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda other: (
        F.least(mine, other).cast("bigint") * F.lit(1 << 31) + F.greatest(mine, other)))
    rows = keyed.join(shared, ["t", "k"]).select("t", "k", F.explode(pairs).alias("tile"), "fp")
    return rows.repartition("t", "k", "tile").sortWithinPartitions("t", "k", "tile").mapInArrow(
        _linked, "a bigint, b bigint")


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) of every linked node, by alternating large and small stars; roots are the smallest nodes."""
    edges = stage(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        near = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else pairs
        least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        moved = near.join(least, "a")
        if large:
            made = moved.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            made = moved.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
                least.filter("a <> m").select("a", F.col("m").alias("b")))
        return made.distinct()

    def mark(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38)"))).first())

    seen = mark(edges)
    while True:
        edges = stage(star(star(edges, True), False), label)
        now = mark(edges)
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp, component) of every row; ``component`` is the smallest id reachable by links."""
    rows = stage(fingerprints(docs, id_column, text), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("id").alias("first")), "nodes")
    roots = components(links(nodes))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("first").alias("component"))
    of_fp = placed.select("fp", "root").join(least, "root").select("fp", "component")
    return rows.join(of_fp, "fp").select("id", "fp", "component")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per group: the one with the smallest id; rows without an id all stay.

    Of several rows with that id the one with the smallest hash of its text stays.
    """
    return keep_first(docs, near_duplicates(docs, id_column, text), id_column, text)


def keep_first(docs: DataFrame, found: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the component that ``found`` (id, component) gives it, each id once.

    A repeated id sends one row per task to the one that decides; rows without an id go past it.
    """
    stays, turn = fresh(docs, "_stays", "_turn")
    key, columns = quoted(id_column), [quoted(c) for c in docs.columns]
    kept = found.filter("id = component").select(F.col("id").alias(stays)).distinct()
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64(quoted(text))))
    first = docs.filter(key.isNotNull()).withColumn(turn, rank).filter(F.col(turn) == 1).select(*columns)
    named = first.join(kept.hint("merge"), key == F.col(stays), "left_semi")
    return named.unionByName(docs.filter(key.isNull()))


def hex_digits(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
