import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperweave.llm import collocations as c

SCHEMA = "doc_id bigint, lang string, text string"


def brute(rows, least, longest=4, top=2000, covered=80):
    """Phrases as lists, by the definition."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = [w for w in re.split("[ \t]", piece) if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    frequent = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    gone = set()
    for (lang, long), a in frequent.items():
        for k in range(2, len(long)):
            for i in range(len(long) - k + 1):
                if 100 * a >= covered * frequent[lang, long[i:i + k]]:
                    gone.add((lang, long[i:i + k]))
    out = []
    for lang in n:
        scored = []
        for (of, words), a in frequent.items():
            if of == lang and (of, words) not in gone:
                cuts = [(2_000_000 * a // (f[of, words[:k]] + f[of, words[k:]]), k) for k in range(1, len(words))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(words).encode(), f[of, words[:k]], f[of, words[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(spark, rows, **how):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    return sorted(tuple(r) for r in c.top_collocations(df, **how).collect())


def corpus(seed=3, n=120):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "a", "é", "你好", "x\u00a0y", "É"]
    fixed = ["new york city hall", "of the", "a b a b a b", "the city of new york"]
    out = []
    for i in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.randrange(25))]
        marks = [rng.choice([" ", " ", " ", "\t", ", ", ".", "  ", "\n", "\x0b", "? "]) for _ in parts]
        out.append((rng.choice(["en", "en", "fr", None, "und", ""]), "".join(p + m for p, m in zip(parts, marks))))
    return out


@pytest.mark.parametrize("sent,held", [(c.SENT, 40), (0, c.HELD_PAIRS)])
def test_against_brute_force(spark, monkeypatch, sent, held):
    """Numbers sent to the tasks, and occurrences shuffled to the numbers."""
    monkeypatch.setattr(c, "SENT", sent)
    monkeypatch.setattr(c, "HELD_PAIRS", held)
    monkeypatch.setattr(c, "HELD_WORDS", held)
    rows = corpus()
    assert found(spark, rows, least=3) == brute(rows, 3) != []


def test_lengths_limits_and_ties(spark):
    rows = corpus(9, 60)
    assert found(spark, rows, least=2, longest=3, top=5, covered=60) == brute(rows, 2, 3, 5, 60)
    # Equal scores: the phrase in byte order decides; every word stands once in a piece of two.
    pairs = [("en", ". ".join(f"w{i} v{i}" for i in range(8)) + ". Z z. é e")] * 3
    got = found(spark, pairs, least=3, top=6)
    assert [r[2] for r in got] == sorted((r[2] for r in brute(pairs, 3)), key=str.encode)[:6]


def test_overlaps_and_long_texts(spark):
    rows = [("en", "a " * 50_000), (None, None), ("en", ""), ("en", " \t\n"), ("fr", "one. two. three")]
    assert found(spark, rows) == brute(rows, 30)


def test_no_rows_and_clashing_names(spark, no_docs, spread):
    assert c.top_collocations(no_docs.withColumn("lang", F.lit("en"))).count() == 0
    rows = [("en", "x y z")] * 40
    df = spread(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)).withColumn("words", F.lit(1))
    assert sorted(tuple(r) for r in c.top_collocations(df).collect()) == brute(rows, 30)
    with pytest.raises(ValueError):
        c.top_collocations(df, longest=1)


def test_sums_past_64_bits(spark):
    row = spark.range(1).select(
        F.lit(9_000_000_000_000_000_000).alias("n"), F.array(F.lit(9_100_000_000_000_000_000)).alias("firsts"),
        F.array(F.lit(9_200_000_000_000_000_000)).alias("rests"))
    assert c.scored(row).first()["score"] == 2_000_000 * 9_000_000_000_000_000_000 // 18_300_000_000_000_000_000


def test_counts_of_large_numbers():
    a, b = np.array([1 << 40, 5, 1 << 40, 5]), np.array([1 << 41, 7, 1 << 41, 8])
    assert [x.tolist() for x in c._counted(a, b)] == [[5, 5, 1 << 40], [7, 8, 1 << 41], [1, 1, 2]]


def test_a_task_works_in_small_slices(monkeypatch):
    """op11: what a task joins, sorts and hands on at once does not grow with its batches."""
    taken, handed = [], []

    class Relation:  # runs the task's function on one batch
        def mapInArrow(self, run, schema):
            handed.extend(run(iter([batch])))
            raise StopIteration

    monkeypatch.setattr(c, "SLICE", 50)
    monkeypatch.setattr(c, "HANDED", 7)
    real = c._joined
    monkeypatch.setattr(c, "_joined", lambda b: taken.append(len(b.column(1).flatten())) or real(b))
    rng = np.random.default_rng(5)
    places = [np.arange(n, dtype=np.int32) for n in (3, 0, 120, 40, 9, 9, 1, 70)]
    groups = [rng.integers(1, 6, len(x)) + (1 << 40) * (i == 3) for i, x in enumerate(places)]
    batch = c._lists(list(range(len(places))), places, groups).slice(1)
    with pytest.raises(StopIteration):
        c.group_counts(Relation())
    assert sum(taken) == 249 and all(n <= 50 or n in (120, 70) for n in taken)
    assert max(h.num_rows for h in handed) <= 7
    got = Counter()
    for h in handed:
        for a, b, n in zip(*[x.to_pylist() for x in h.columns]):
            got[a, b] += n
    assert got == Counter((int(a), int(b)) for g in groups[1:] for a, b in zip(g, g[1:]))
