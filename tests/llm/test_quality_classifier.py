import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperweave.llm import quality_classifier as q


def brute_features(text):
    """Words, pairs and n-grams by plain loops; n-grams may begin and end with a blank."""
    words = text.split(" ")
    words = [w for w in words if w]
    grams = [text[i:i + n] for n in q.LENGTHS for i in range(len(text) - n + 1) if " " not in text[i + 1:i + n - 1]]
    return len(words), len(words) - 1 if words else 0, len(grams)


def features_of(text):
    return [f for codes, owners in q.pieces([text]) for f in q.features(codes, owners)]


@pytest.mark.parametrize("text", ["one two two three", "a", "ab cd", "Grüße 你好 \U0001F600 x"])
def test_feature_counts(text):
    grams3, grams4, words, pairs = (len(b) for b, _ in features_of(text))
    n_words, n_pairs, n_grams = brute_features(f" {text} ")
    assert (words, pairs, grams3 + grams4) == (n_words, n_pairs, n_grams)


def test_same_word_same_bucket_anywhere():
    (*_, (first, _), _), (*_, (second, _), _) = features_of("alpha beta"), features_of("zzz zz beta yy alpha")
    assert set(first) <= set(second)


def test_words_that_follow_themselves_are_one_feature():
    (*_, (a, _)), (*_, (b, _)) = features_of("no no no"), features_of("yes yes")
    assert set(a) == set(b) and len(set(a)) == 1


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(f"word{i % 97}" for i in range(5000))
    at, n = q.counted(text)
    monkeypatch.setattr(q, "PIECE", 1000)
    at2, n2 = q.counted(text)
    # Only pairs and n-grams across the ends of pieces may be missing.
    assert set(at2) <= set(at) and n.sum() - n2.sum() < 0.05 * n.sum()


def test_held_out_as_crc32(spark):
    rows = spark.range(300).select("id", q.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)


def test_sample_is_bounded_and_never_held_out(spark):
    labels = spark.range(2000).select(F.col("id").alias("doc_id"), (F.col("id") % 5 > 0).cast("int").alias("quality"))
    rows = q.sample_of(labels.unionByName(labels.selectExpr("doc_id", "null as quality")), "doc_id", "quality", 100).collect()
    assert len(rows) == 100 and sum(r.label for r in rows) == 50
    assert not any(zlib.crc32(str(r.id).encode()) % 3 == 1 for r in rows)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scored = q.score(docs, q.fit(docs, labels)).join(labels, F.col("id") == F.col("doc_id")).filter(q.held_out(F.col("id"))).collect()
    good = [r.score for r in scored if r.quality == 1]
    bad = [r.score for r in scored if r.quality == 0]
    assert np.mean([s >= 0.5 for s in good]) > 0.95 and np.mean([s < 0.5 for s in bad]) > 0.8
    auc = np.mean([[g > b for b in bad] for g in good])
    assert auc > 0.97


def test_odd_rows(odd_docs, no_docs, spread, spark):
    model = (np.random.default_rng(0).normal(size=1 << q.BUCKETS_LOG2), 0.25)
    rows = q.score(spread(odd_docs), model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    of = {r.id: r.score for r in rows}
    assert of[2] == of[3] == of[4] == round(1 / (1 + np.exp(-0.25)), 6) and of[1] == of[7] != of[5]
    assert q.score(no_docs, model).count() == 0
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert q.fit(odd_docs, none)[1] == 0.0 and not q.fit(no_docs, none)[0].any()


def test_scores_do_not_depend_on_the_batch(spark, odd_docs):
    model = (np.random.default_rng(0).normal(size=1 << q.BUCKETS_LOG2), 0.0)
    whole = {r.id: r.score for r in q.score(odd_docs.coalesce(1), model).collect()}
    assert {r.id: r.score for r in q.score(odd_docs.repartition(7), model).collect()} == whole
