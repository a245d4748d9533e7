"""Line dedup by a template tree of fixed depth.

Lines of at least ``LEAST_WORDS`` words are parsed: words with digits become
variable fields. A leaf is the number of words with the first ``DEPTH`` of them; its
other places are cut into up to ``SEGMENTS`` segments. A template of a line has the
words of some segments in place and fields in the others, such that at least
``SIMILAR`` of all places hold a word. So two lines share a template if they differ
in few places, and where that is depends on no other line. A line goes from a
document if one with a smaller id has a line that shares a template with it. There is no order of lines and no size
at which another rule begins, and documents with larger ids change nothing.

A line with too few words that stay, and one of fewer than ``LEAST_WORDS`` words,
recurs only as it is, the latter from ``SHORT_CHARS`` characters on (``DENSE_CHARS``
of scripts that don't put blanks between words).

1. One pass gives narrow rows (leaf, body, document, line).
2. A bitmap of fixed size marks the leaves with more than one body. A second
   pass sends the hashes of the templates of their lines, each line once per task.
3. The smallest document of each template goes back to its lines, with templates
   dealt out in parts so that one with many lines is no single group.
4. Dropped line numbers go to their documents by one join.

Defined results: rows whose id or text is null stay as they are and count for
nothing. Rows with the same id are one document. Repeats inside one document
are left alone. A document may become empty; ``drop_lines`` keeps it,
``without_emptied`` does not. An empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperweave.llm.common import fresh, need, quoted
from paperweave.workspace import stage

DEPTH, LEAST_WORDS, SIMILAR = 3, 6, 0.7
SEGMENTS = 7  # two of seven are below three tenths of a line, so a long line may differ in two
SHORT_CHARS, DENSE_CHARS = 16, 10
FIELD = "<*>"
LEAF_BITS = 1 << 23  # of the bitmap: 1 MB
PARTS = 16  # of a template's lines
ROWS = 20_000
DIGIT = re.compile(r"\d")
# Han, kana, Thai, Lao, Tibetan, Burmese and Khmer letters.
DENSE = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def parsed(line: str) -> list[str] | None:
    """The line's words with variable fields; None if the line is too short to judge.

    A line that recurs only as it is is one word of its own, so only equal lines meet it.
    """
    if len(line) < DENSE_CHARS:
        return None
    words = line.split()
    if len(words) < LEAST_WORDS:
        long = sum(map(len, words)) >= SHORT_CHARS or len(DENSE.findall(line)) >= DENSE_CHARS
        return [" ".join(words)] if long else None
    if DIGIT.search(line):
        masked = [FIELD if DIGIT.search(w) else w for w in words]
        if len(words) - masked.count(FIELD) < SIMILAR * len(words) - 1e-9:
            return [" ".join(words)]
        words = masked
    return words


@lru_cache(maxsize=4096)
def segments(n: int) -> tuple[tuple[int, int], ...]:
    """[start, end) of the segments of a line of ``n`` words, as equal as can be."""
    parts = min(SEGMENTS, n - DEPTH)
    return tuple((DEPTH + i * (n - DEPTH) // parts, DEPTH + (i + 1) * (n - DEPTH) // parts) for i in range(parts))


@lru_cache(maxsize=65_536)
def _kept(n: int, words: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Templates of lines with that many words, not fields, before and in the segments: kept segments and a salt each.

    Only templates with as many fields as can be: lines that share another one share one of these.
    """
    from xxhash import xxh3_64_intdigest as digest

    spare = sum(words) - int(np.ceil(SIMILAR * n - 1e-9))
    cost, places = words[1:], range(len(words) - 1)
    fits = [set(t) for size in places for t in combinations(places, size) if sum(cost[i] for i in t) <= spare]
    most = [t for t in fits if not any(t < other for other in fits)]
    kept = np.array([[i not in t for i in places] for t in most], np.uint64)
    return kept, np.array([digest(bytes(row.astype(np.uint8))) for row in kept], np.uint64)


def template_hashes(words: list[str], leaf: int) -> np.ndarray:
    """Hashes of the templates of a parsed line."""
    from xxhash import xxh3_64_intdigest as digest

    n, cuts = len(words), segments(len(words))
    held = tuple(sum(w != FIELD for w in words[a:b]) for a, b in ((0, DEPTH), *cuts))
    kept, salt = _kept(n, held)
    parts = np.array([digest(" ".join(words[a:b]), seed=i + 1) for i, (a, b) in enumerate(cuts)], np.uint64)
    return ((kept * parts).sum(axis=1, dtype=np.uint64) + np.uint64(leaf)) ^ salt


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(leaf, body, id, row, line) of every judged line."""
    from xxhash import xxh3_64_intdigest as digest

    for batch in batches:
        ids, rows = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        leaves, bodies, at, lines = [], [], [], []
        for i, text in enumerate(batch.column(2)):
            for number, line in enumerate(text.as_py().split("\n")):
                if words := parsed(line):
                    leaves.append(digest(f"{len(words)} {' '.join(words[:DEPTH])}"))
                    bodies.append(digest(" ".join(words)))
                    at.append(i)
                    lines.append(number)
        columns = [np.array(leaves, np.uint64).view(np.int64), np.array(bodies, np.uint64).view(np.int64),
                   ids[at] if at else np.zeros(0, np.int64), rows[at] if at else np.zeros(0, np.int64),
                   np.array(lines, np.int32)]
        for i in range(0, len(leaves), ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(c[i:i + ROWS]) for c in columns], ["leaf", "body", "id", "row", "line"])


def _marked_lines(bitmap: bytes):
    """(leaf, body, templates) of lines in marked leaves, each once per task as far as memory goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as digest

        sent: set[int] = set()

        def rows(found: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
            leaves, bodies, hashes = zip(*found)
            ends = np.cumsum([0, *map(len, hashes)]).astype(np.int32)
            return pa.RecordBatch.from_arrays([
                pa.array(np.array(leaves, np.uint64).view(np.int64)), pa.array(np.array(bodies, np.uint64).view(np.int64)),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(hashes).view(np.int64)))],
                ["leaf", "body", "templates"])

        found: list[tuple[int, int, np.ndarray]] = []
        for batch in batches:
            for text in batch.column(0):
                for line in text.as_py().split("\n"):
                    words = parsed(line)
                    if words is None or len(words) == 1:
                        continue
                    leaf = digest(f"{len(words)} {' '.join(words[:DEPTH])}")
                    bit = leaf % LEAF_BITS
                    if bitmap[bit >> 3] >> (bit & 7) & 1:
                        body = digest(" ".join(words))
                        if body not in sent:
                            if len(sent) > 500_000:
                                sent.clear()
                            sent.add(body)
                            found.append((leaf, body, template_hashes(words, leaf)))
                            if len(found) == ROWS:
                                yield rows(found)
                                found = []
        if found:
            yield rows(found)

    return run


def across_templates(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(leaf, body, earliest): the smallest id that has a line sharing a template with the body.

    ``docs`` has the column text and ``found`` the bodies with their first and last id. Bodies without such a line
    in another document may be missing.
    """
    spark = docs.sparkSession
    full = found.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    place = F.pmod("leaf", F.lit(LEAF_BITS))  # the hash as unsigned leaves the same rest: the size divides 2^64
    words = full.groupBy(F.call_function("div", place, F.lit(32)).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 32).cast("int"))).alias("bits"))
    bitmap = np.zeros(LEAF_BITS // 32, "<u4")
    for at, bits in words.collect():  # at most LEAF_BITS / 32 rows
        bitmap[at] = bits
    shared = spark.sparkContext.broadcast(bitmap.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _marked_lines(shared.value)(batches)

    hashed = docs.select("text").mapInArrow(run, "leaf bigint, body bigint, templates array<bigint>").groupBy("leaf", "body").agg(
        F.any_value("templates").alias("templates"))
    bodies = stage(hashed.join(found, ["leaf", "body"]), "line-templates")
    shares = bodies.select("leaf", "body", "first", "last", F.explode("templates").alias("template"))
    earliest = shares.groupBy("template").agg(F.min("first").alias("earliest"), F.max("last").alias("last")).filter(
        "earliest < last").select("template", "earliest", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    dealt = shares.select("leaf", "body", "template", F.pmod("body", F.lit(PARTS)).cast("int").alias("part"))
    return dealt.join(earliest, ["template", "part"]).groupBy("leaf", "body").agg(F.min("earliest").alias("earliest"))


def recurring(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, row, lines): the line numbers, from 0, that each row loses."""
    need(docs, id_column, text)
    rows = docs.select(quoted(id_column).cast("bigint").alias("id"), quoted(text).alias("text")).filter(
        "id is not null and text is not null")
    keyed = rows.select("id", F.xxhash64("text").alias("row"), "text")
    lines = stage(keyed.mapInArrow(_parse, "leaf bigint, body bigint, id bigint, row bigint, line int"), "lines")
    found = stage(lines.groupBy("leaf", "body").agg(F.min("id").alias("first"), F.max("id").alias("last")), "line-bodies")
    bodies = found.join(across_templates(rows, found), ["leaf", "body"], "left").select(
        "leaf", "body", "last", F.least("first", "earliest").alias("stays")).filter("stays < last").drop("last")
    gone = lines.join(bodies, ["leaf", "body"]).filter("id > stays")
    return gone.groupBy("id", "row").agg(F.collect_set("line").alias("lines"))


def drop_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` without the recurring lines; ``count`` names a column for how many each row lost."""
    gone = stage(recurring(docs, id_column, text), "dropped-lines")
    a, b, c = fresh(docs, "_id", "_row", "_lines")
    gone = gone.select(F.col("id").alias(a), F.col("row").alias(b), F.col("lines").alias(c))
    joined = docs.join(gone.hint("merge"), (quoted(id_column) == F.col(a)) & (F.xxhash64(quoted(text)) == F.col(b)), "left")
    rest = F.array_join(F.filter(F.split(quoted(text), "\n"), lambda _, i: ~F.array_contains(F.col(c), i)), "\n")
    changed = F.when(F.col(c).isNull(), quoted(text)).otherwise(rest)
    lost = [F.coalesce(F.size(c), F.lit(0)).cast("bigint").alias(count)] if count else []
    return joined.select(*[changed.alias(x) if x == text else quoted(x) for x in docs.columns], *lost)


def without_emptied(before: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``before`` without the recurring lines and without rows that lost all their words to it."""
    (lost,) = fresh(before, "_lost")
    after = drop_lines(before, id_column, text, lost)
    return after.filter((F.col(lost) == 0) | quoted(text).rlike("[^ \\t-\\r]")).drop(lost)
