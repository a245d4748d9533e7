"""Phrase collocations by set-oriented (SETM) mining over occurrence relations.

1. Words are counted per language. A word that occurs ``LEAST`` times gets a number.
2. R1, the occurrences of these words, is written once, sorted by piece and
   position. A document's occurrences are one row of two parallel arrays;
   positions of different pieces are never neighbours, so a position stands for
   both. Nothing is shuffled to make it.
3. R_k comes from R_(k-1) by a merge join with itself on piece and adjacent
   position: two groups of k - 1 words that start at neighbouring positions
   overlap in k - 2 words and make one of k words. The joined groups are counted,
   those below ``LEAST`` are dropped, the others are numbered, and R_k is the
   semi-join of the joined occurrences with them, written like R1.
4. A frequent group knows the counts of its first and last parts and the groups
   it holds from the two it was made of, so scores need no further join.

Only frequent numbers meet the occurrences. Up to ``SENT`` of them go to the tasks;
beyond that the occurrences are shuffled to them and back, with the same result.
Counts are combined in a task before they are shuffled.

Defined results: a null text is empty, a null language is ``und``. A document is
counted as often as its row is repeated. Scores are whole numbers from decimal
arithmetic. Ties: score, then count, both descending, then the phrase in byte
order. Texts without a frequent phrase, and empty tables, give no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperweave.llm.common import need, quoted
from paperweave.operators.order import dense_row_index
from paperweave.workspace import stage

LEAST, LONGEST, TOP, COVERED = 30, 4, 2000, 80
SENT = 1_000_000  # frequent groups sent to the tasks; at most 24 bytes each, words 100
HELD_WORDS, HELD_PAIRS = 300_000, 3_000_000  # what a task combines before it hands counts on
HANDED = 1 << 16  # rows of counts handed on at once; Spark's side takes a batch as a whole
SLICE = 500_000  # occurrences that a task joins or makes at once
SALTS = 16
MARKS = b".,;:!?\n\x0b\x0c\r"
_ENDS = bytes.maketrans(MARKS + b"\t", b"\n" * len(MARKS) + b" ")
_BLANKS = bytes.maketrans(MARKS, b" " * len(MARKS))
_R = "doc bigint, places array<int>, groups array<bigint>"


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    need(docs, text, lang)
    return docs.select(
        F.monotonically_increasing_id().alias("doc"), F.coalesce(quoted(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(quoted(text), F.lit("")).cast("binary").alias("text"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, n) of all words; a task combines its counts and hands them on when they are many."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)

        def out() -> Iterator[pa.RecordBatch]:
            for lang, found in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(list(found), pa.binary()).cast(pa.string()),
                     pa.array(list(found.values()), pa.int64())], ["lang", "word", "n"])
            counts.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                found = counts[lang.as_py()]
                found.update(text.as_py().lower().translate(_BLANKS).split())
                if len(found) > HELD_WORDS:
                    yield from out()
        yield from out()

    parts = texts.select("lang", "text").mapInArrow(run, "lang string, word string, n bigint")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _tokens(text: bytes) -> list[bytes]:
    """Words with a newline between pieces."""
    return [t for t in text.lower().translate(_ENDS).replace(b"\n", b" \n ").split(b" ") if t]


def _lists(docs: list[int], places: list[np.ndarray], groups: list[np.ndarray]) -> pa.RecordBatch:
    offsets = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in places])]).astype(np.int32))
    joined = [np.concatenate([np.zeros(0, t), *x]) for x, t in ((places, np.int32), (groups, np.int64))]
    return pa.RecordBatch.from_arrays(
        [pa.array(docs, pa.int64())] + [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in joined],
        ["doc", "places", "groups"])


def _gathered(flat: DataFrame) -> DataFrame:
    """Rows (doc, place, group) as one sorted row per document."""
    row = flat.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("place", "group"))).alias("x"))
    return row.select("doc", F.col("x.place").alias("places"), F.col("x.group").alias("groups"))


def _salted(flat: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Join with a table that has each key once; rows of a frequent key are dealt to several tasks."""
    salt = F.pmod(F.xxhash64("doc", "place"), F.lit(SALTS)).cast("int")
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return flat.withColumn("_salt", salt).join(copies.hint("merge"), [*keys, "_salt"]).drop("_salt")


def first_relation(texts: DataFrame, words: DataFrame) -> DataFrame:
    """R1: the occurrences of the numbered words (id, lang, word)."""
    if words.count() > SENT:
        def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for doc, lang, text in zip(*batch.columns):
                    found = [(i, t) for i, t in enumerate(_tokens(text.as_py())) if t != b"\n"]
                    for at in range(0, len(found), 1 << 16):
                        part = found[at:at + (1 << 16)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([doc.as_py()] * len(part), pa.int64()), pa.array([i for i, _ in part], pa.int32()),
                             pa.array([lang.as_py()] * len(part), pa.string()),
                             pa.array([t for _, t in part], pa.binary()).cast(pa.string())],
                            ["doc", "place", "lang", "word"])

        rows = texts.mapInArrow(flat, "doc bigint, place int, lang string, word string")
        joined = _salted(rows, words.select("lang", "word", F.col("id").alias("group")), ["lang", "word"])
        return stage(_gathered(joined), "occurrences-1")

    numbers: dict[str, dict[bytes, int]] = defaultdict(dict)
    for row in words.select("lang", "word", "id").collect():
        numbers[row["lang"]][row["word"].encode()] = row["id"]
    sent = texts.sparkSession.sparkContext.broadcast(dict(numbers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, places, groups, size = [], [], [], 0
            for doc, lang, text in zip(*batch.columns):
                of = sent.value.get(lang.as_py())
                if not of:
                    continue
                tokens = _tokens(text.as_py())
                ids = np.fromiter((of.get(t, 0) for t in tokens), np.int64, len(tokens))
                at = np.flatnonzero(ids)
                if len(at):
                    kept.append(doc.as_py())
                    places.append(at.astype(np.int32))
                    groups.append(ids[at])
                    size += len(at)
                if size > SLICE:
                    yield _lists(kept, places, groups)
                    kept, places, groups, size = [], [], [], 0
            if kept:
                yield _lists(kept, places, groups)

    return stage(texts.mapInArrow(run, _R), "occurrences-1")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with ``SLICE`` occurrences together, or one row with more."""
    for batch in batches:
        ends = batch.column(1).offsets.to_numpy()
        at = 0
        while at < batch.num_rows:
            end = max(int(np.searchsorted(ends, ends[at] + SLICE, side="right")) - 1, at + 1)
            yield batch.slice(at, end - at)
            at = end


def _joined(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Merge join of a batch's occurrences on adjacent positions: (row, place, first group, second group)."""
    column = batch.column(1)
    offsets = column.offsets.to_numpy()
    base = offsets[0] if len(offsets) else 0
    places = column.values.to_numpy()[base:offsets[-1]]
    groups = batch.column(2).values.to_numpy()[base:offsets[-1]]
    row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
    at = np.flatnonzero((places[1:] == places[:-1] + 1) & (row[1:] == row[:-1]))
    return row[at], places[at], groups[at], groups[at + 1]


def _counted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    step = int(b.max(initial=0)) + 1
    if int(a.max(initial=0)) < (1 << 62) // step:  # both fit one number, which needs less room to sort
        both = a.astype(np.int64)
        both *= step
        both += b
        both.sort()
        start = np.flatnonzero(np.r_[True, both[1:] != both[:-1]]) if len(both) else np.zeros(0, int)
        return both[start] // step, both[start] % step, np.diff(np.r_[start, len(both)])
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    start = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, int)
    return a[start], b[start], np.diff(np.r_[start, len(a)])


def group_counts(relation: DataFrame) -> DataFrame:
    """(a, b, n) of the groups that a merge join of the relation with itself makes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            pairs = [np.concatenate([h[i] for h in held]) for i in (0, 1)]
            held.clear()
            counts = _counted(*pairs)
            del pairs
            for at in range(0, len(counts[0]), HANDED):
                yield pa.RecordBatch.from_arrays([pa.array(c[at:at + HANDED], pa.int64()) for c in counts], ["a", "b", "n"])

        for part in _slices(batches):
            _, _, a, b = _joined(part)
            if max(a.max(initial=0), b.max(initial=0)) < 1 << 31:  # numbers are dense, so half the room will do
                a, b = a.astype(np.int32), b.astype(np.int32)
            held.append((a, b))
            size += len(a)
            if size > HELD_PAIRS:
                yield from out()
                size = 0
        if size:
            yield from out()

    return relation.mapInArrow(run, "a bigint, b bigint, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))


def next_relation(relation: DataFrame, frequent: DataFrame, k: int) -> DataFrame:
    """R_k: the joined occurrences whose group is frequent (id, a, b)."""
    if frequent.count() > SENT:
        def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches):
                row, place, a, b = _joined(batch)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(place), pa.array(a), pa.array(b)], ["doc", "place", "a", "b"])

        rows = relation.mapInArrow(flat, "doc bigint, place int, a bigint, b bigint")
        return stage(_gathered(_salted(rows, frequent.select("a", "b", F.col("id").alias("group")), ["a", "b"])), f"occurrences-{k}")

    table = frequent.select("a", "b", "id").toArrow()
    a, b, ids = (table.column(c).to_numpy() for c in ("a", "b", "id"))
    order = np.lexsort((b, a))
    sent = relation.sparkSession.sparkContext.broadcast((a[order], b[order], ids[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, seconds, numbers = sent.value
        # (a, b) as one number: the rank of a among the first groups, then b.
        starts = np.unique(firsts)
        step = int(seconds.max(initial=0)) + 1
        keys = np.searchsorted(starts, firsts) * step + seconds
        for batch in _slices(batches):
            row, place, a, b = _joined(batch)
            rank = np.minimum(np.searchsorted(starts, a), max(len(starts) - 1, 0))
            wanted = rank * step + b
            at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
            hit = (keys[at] == wanted) & (starts[rank] == a) & (b < step) if len(keys) else np.zeros(len(a), bool)
            row, place, group = row[hit], place[hit], numbers[at[hit]]
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
            full = np.flatnonzero(np.diff(cuts))
            if len(full):
                offsets = pa.array(np.r_[cuts[full], cuts[-1]].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(full)), pa.ListArray.from_arrays(offsets, pa.array(place.astype(np.int32))),
                     pa.ListArray.from_arrays(offsets, pa.array(group))], ["doc", "places", "groups"])

    return stage(relation.mapInArrow(run, _R), f"occurrences-{k}")


def _widened(frequent: DataFrame, shorter: DataFrame, k: int) -> DataFrame:
    """Frequent groups with their words and what they know from the two groups they were made of.

    ``firsts`` and ``rests`` are the counts of the parts at every cut, ``inner`` the
    candidates that the group holds.
    """
    def side(letter: str) -> DataFrame:
        return shorter.select(F.col("id").alias(letter), F.struct(*[c for c in shorter.columns if c != "id"]).alias(f"_{letter}"))

    both = frequent.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")
    inner = F.array_union("_a.inner", "_b.inner")
    if k > 2:
        inner = F.array_union(inner, F.array(*[
            F.struct(F.lit(k - 1).alias("k"), F.col(x).alias("id"), F.col(f"_{x}.n").alias("n")) for x in "ab"]))
    return both.select(
        "id", F.col("_a.lang").alias("lang"), F.concat("_a.words", F.slice("_b.words", -1, 1)).alias("words"), "n",
        F.array_append("_a.firsts", F.col("_a.n")).alias("firsts"),
        F.concat(F.array("_b.n"), "_b.rests").alias("rests"), inner.alias("inner"))


def candidates(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """All phrases of 2 to ``longest`` words found ``least`` times or more, and (lang, n) with the number of words.

    Phrases: ``k, id, lang, words, n, firsts, rests, inner`` (see ``_widened``).
    """
    if least < 1 or longest < 2:
        raise ValueError("a phrase has two words or more and occurs once at least")
    texts = _texts(docs, text, lang)
    counts = stage(word_counts(texts), "words")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    words = dense_row_index(counts.filter(F.col("n") >= least), ["lang", "word"], "id", 1)
    relation = first_relation(texts, words)
    known = words.select(
        "id", "lang", F.array("word").alias("words"), "n", F.array().cast("array<bigint>").alias("firsts"),
        F.array().cast("array<bigint>").alias("rests"), F.array().cast("array<struct<k:int,id:bigint,n:bigint>>").alias("inner"))
    found = None
    for k in range(2, longest + 1):
        frequent = dense_row_index(group_counts(relation).filter(F.col("n") >= least), ["a", "b"], "id", 1)
        known = stage(_widened(frequent, known, k), f"phrases-{k}")
        rows = known.withColumn("k", F.lit(k))
        found = rows if found is None else found.unionByName(rows)
        if k < longest:
            relation = next_relation(relation, frequent, k)
    return found, totals


def _whole(x: Column) -> Column:
    return x.cast("decimal(20,0)")


def scored(phrases: DataFrame) -> DataFrame:
    """Adds ``l, r, score`` of the cut with the lowest score, the first of equal ones."""
    cuts = F.transform(F.arrays_zip("firsts", "rests"), lambda x, i: F.struct(
        F.call_function("div", _whole(F.col("n")) * F.lit(2_000_000).cast("decimal(7,0)"),
                        _whole(x["firsts"]) + _whole(x["rests"])).alias("score"),
        i.alias("cut"), x["firsts"].alias("l"), x["rests"].alias("r")))
    return phrases.withColumn("_best", F.array_min(cuts)).select(
        "*", F.col("_best.l").alias("l"), F.col("_best.r").alias("r"), F.col("_best.score").alias("score")).drop("_best")


def not_covered(phrases: DataFrame, covered: int = COVERED) -> DataFrame:
    """Phrases that no longer one holds ``covered`` percent of the time."""
    held = phrases.select("n", F.explode("inner").alias("x")).filter(
        _whole(F.col("n")) * 100 >= _whole(F.col("x.n")) * covered).select("x.k", "x.id").distinct()
    return phrases.join(held.hint("merge"), ["k", "id"], "left_anti")


def top_collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
    top: int = TOP, covered: int = COVERED,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases."""
    phrases, totals = candidates(docs, text, lang, least, longest)
    rows = scored(not_covered(phrases, covered)).select(
        "lang", F.array_join("words", " ").alias("phrase"), F.col("n").alias("a"), "l", "r", "score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language may hold most rows: each of several parts gives its best, then those are ranked.
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    first = rows.withColumn("_part", part).withColumn(
        "_turn", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).filter(F.col("_turn") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.filter(F.col("rank") <= top).join(totals.hint("merge"), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
