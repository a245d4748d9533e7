"""Quality classifier: supervised subword embeddings.

A text's features are its words, pairs of words and character n-grams, hashed to
buckets.
Each bucket has a learned vector; a document is the mean of its features'
vectors, and a softmax layer gives the class. Training is stochastic gradient
descent in numpy on a sample of labelled rows of bounded size (``SAMPLE``, the
smallest hashes of the ids, half of each class where there are enough).

Mean and layer are linear, so a trained model is one number per bucket and one
offset: scoring adds up table entries over the whole text, whatever its length,
in pieces that end at blanks. Scoring needs no shuffle.

Defined results: a text without words (null, empty, blank) gets the model's
score for no features. Repeated rows score alike. An empty table gives an empty
one. Labels that are null are not learned from; without labels of both classes
every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperweave.llm.common import need, quoted

BUCKETS_LOG2, DIMS = 16, 8
LENGTHS = (3, 4)
ECHO = 0x5EED
SAMPLE = 3000
EPOCHS, BATCH, RATE = 12, 32, 1.0
PIECE = 1 << 17  # characters hashed at once
STEP = np.uint64(0x9E3779B97F4A7C15)
UNDO = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SPACE = np.array([32], np.uint32)
BLANK = np.zeros(1 << 21, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(code points, document of each) a piece at a time; texts are cut at blanks and stand between blanks."""
    codes, owners, size = [], [], 0
    for i, text in enumerate(texts):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        at = 0
        while at < len(points):
            end = min(at + PIECE, len(points))
            if end < len(points):
                later = np.flatnonzero(BLANK[points[end:end + 4096]])
                while not len(later) and end < len(points):
                    end = min(end + 4096, len(points))
                    later = np.flatnonzero(BLANK[points[end:end + 4096]])
                end += int(later[0]) if len(later) else 0
            codes += [SPACE, points[at:end], SPACE]
            owners.append(np.full(end - at + 2, i))
            size += end - at + 2
            at = end
            if size >= PIECE:
                yield np.concatenate(codes), np.concatenate(owners)
                codes, owners, size = [], [], 0
    if size:
        yield np.concatenate(codes), np.concatenate(owners)


def features(codes: np.ndarray, owners: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, document) of every word and n-gram. ``codes`` ends with a blank."""
    shift = np.uint64(64 - BUCKETS_LOG2)
    wide, blank = codes.astype(np.uint64) + np.uint64(1), BLANK[codes]
    before = np.cumsum(blank)

    def bucket(hashes: np.ndarray, salt: int) -> np.ndarray:
        mixed = (hashes ^ np.uint64(salt)) * STEP
        return ((mixed ^ (mixed >> np.uint64(29))) * STEP) >> shift

    # An n-gram may begin or end with the blank around its word, with none inside.
    gram = wide
    for n in range(2, max(LENGTHS) + 1):
        gram = gram[:-1] * STEP + wide[n - 1:]
        if n in LENGTHS:
            inside = before[n - 2:n - 2 + len(gram)] - before[:len(gram)]
            at = np.flatnonzero(inside == 0)
            yield bucket(gram[at], n), owners[at]

    # A word's hash is a difference of sums of code x STEP^place, brought back to its start.
    starts = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
    ends = np.flatnonzero(~blank & np.r_[blank[1:], True]) + 1
    powers = np.cumprod(np.r_[np.uint64(1), np.full(len(codes), STEP, np.uint64)])
    sums = np.r_[np.uint64(0), np.cumsum(wide * powers[:-1], dtype=np.uint64)]
    back = np.cumprod(np.r_[np.uint64(1), np.full(len(codes), UNDO, np.uint64)])
    words, of = (sums[ends] - sums[starts]) * back[starts], owners[starts]
    yield bucket(words, 0), of

    # Pairs of words; all words that follow themselves are one feature.
    at = np.flatnonzero(of[1:] == of[:-1])
    pairs = np.where(words[at] == words[at + 1], np.uint64(ECHO), words[at] * UNDO + words[at + 1])
    yield bucket(pairs, 1), of[at]


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text's buckets and how often each occurs."""
    counts = np.zeros(1 << BUCKETS_LOG2, np.int64)
    for codes, owners in pieces([text]):
        for buckets, _ in features(codes, owners):
            counts += np.bincount(buckets.astype(np.int64), minlength=len(counts))
    at = np.flatnonzero(counts)
    return at, counts[at]


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> tuple[np.ndarray, float]:
    """(number per bucket, offset): what each feature adds to the log-odds of class 1."""
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (1 << BUCKETS_LOG2, DIMS))
    layer, offset = rng.normal(0, 0.1, (DIMS, 2)), np.zeros(2)
    classes = {y for *_, y in examples}
    if len(classes) < 2:
        return np.zeros(1 << BUCKETS_LOG2), 0.0
    steps, step = EPOCHS * -(-len(examples) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(examples))
        for i in range(0, len(order), BATCH):
            chosen = [examples[j] for j in order[i:i + BATCH]]
            rate = RATE * (1 - step / steps)
            step += 1
            ids = np.concatenate([b for b, _, _ in chosen])
            share = np.concatenate([c / max(c.sum(), 1) for _, c, _ in chosen])
            rows = np.repeat(np.arange(len(chosen)), [len(b) for b, _, _ in chosen])
            means = np.stack([np.bincount(rows, share * vectors[ids, d], minlength=len(chosen)) for d in range(DIMS)], axis=1)
            logits = means @ layer + offset
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            slope = odds / odds.sum(axis=1, keepdims=True)
            slope[np.arange(len(chosen)), [y for *_, y in chosen]] -= 1
            slope /= len(chosen)
            to_means = slope @ layer.T
            layer -= rate * (means.T @ slope)
            offset -= rate * slope.sum(axis=0)
            # A feature's slope is its share of the text; the rate grows with the number of
            # features among which the shares are split, so long texts teach as much as short ones.
            weight = share * np.repeat([len(b) for b, _, _ in chosen], [len(b) for b, _, _ in chosen])
            for d in range(DIMS):
                vectors[:, d] -= rate * np.bincount(ids, weight * to_means[rows, d], minlength=len(vectors))
    return vectors @ (layer[:, 1] - layer[:, 0]), float(offset[1] - offset[0])


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def sample_of(labels: DataFrame, id_column: str, label: str, size: int = SAMPLE) -> DataFrame:
    """(id, label) of at most ``size`` rows to learn from, none of them held out."""
    rows = labels.select(quoted(id_column).cast("bigint").alias("id"), quoted(label).cast("int").alias("label")).filter(
        F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    parts = [rows.filter(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(size // 2) for c in (0, 1)]
    return parts[0].unionByName(parts[1])


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality",
        size: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Learn from whole texts of the sample; only their hashed counts reach the driver, ``size`` rows at most."""
    need(docs, id_column, text)
    need(labels, id_column, label)
    chosen = F.broadcast(sample_of(labels, id_column, label, size))
    rows = docs.select(quoted(id_column).cast("bigint").alias("id"), F.coalesce(quoted(text), F.lit("")).alias("text")).join(
        chosen, "id").select("id", "label", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, value in enumerate(batch.column(2)):
                at, n = counted(value.as_py())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1),
                     pa.array([at.astype("<u4").tobytes()]), pa.array([n.astype("<u4").tobytes()])],
                    ["id", "label", "at", "n"])

    # Ids that occur twice would pass the bound; the smallest row of each stays.
    found = rows.mapInArrow(count, "id bigint, label int, at binary, n binary").dropDuplicates(["id"]).orderBy("id").limit(size)
    examples = [(np.frombuffer(r["at"], "<u4").astype(np.int64), np.frombuffer(r["n"], "<u4").astype(float), r["label"])
                for r in found.toLocalIterator()]
    return train(examples)


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score): the probability of class 1 of every row."""
    need(docs, id_column, text)
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast((model[0].astype(np.float64), model[1]))
    rows = docs.select(quoted(id_column).alias("id"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, offset = shared.value
        for batch in batches:
            sums, counts = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for codes, owners in pieces_of(batch.column(1)):
                first = int(owners[0])
                for buckets, of in features(codes, owners):
                    if len(of):
                        added = np.bincount(of - first, table[buckets])
                        sums[first:first + len(added)] += added
                        counts[first:first + len(added)] += np.bincount(of - first)
            logits = offset + sums / np.maximum(counts, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.round(1 / (1 + np.exp(-np.clip(logits, -50, 50))), 6))], ["id", "score"])

    return rows.mapInArrow(run, f"id {kind}, score double")


def pieces_of(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pieces of a column of texts, taken out of Arrow a few at a time."""
    for i in range(0, len(column), 64):
        for codes, owners in pieces(column.slice(i, 64).to_pylist()):
            yield codes, owners + i
