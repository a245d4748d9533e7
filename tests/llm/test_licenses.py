import math
import random

import pytest

from paperweave.llm import licenses as li


def words_of(text):
    out = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c if c.isalnum() or ord(c) > 127 else " " for c in text)
    return [w for w in out.split(" ") if w]


def brute(text, templates=li.TEMPLATES, threshold=li.THRESHOLD):
    text = text or ""
    words = words_of(text)
    places = [(i, label) for p, label in li.PHRASES.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    labels, best = {x for _, x in places}, 0.0
    for line in text.split("\n"):
        block = set(words_of(line))
        for label, t in templates:
            t = set(words_of(t))
            if len(t) >= li.LEAST_WORDS and len(block & t) >= math.ceil(threshold * len(t) - 1e-9):
                labels.add(label)
                best = max(best, len(block & t) / len(t))
    at = [i for i, _ in places]
    return (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})),
            ",".join(sorted(labels)), 1.0 if at else best)


def rows_of(df):
    return sorted((r.id or -1, tuple(r)[1:8]) for r in df.collect())


@pytest.mark.parametrize("which", ["odd_docs", "docs", "no_docs"])
def test_against_brute_force(request, which):
    docs = request.getfixturevalue(which)
    assert rows_of(li.scan(docs)) == sorted((r.doc_id or -1, brute(r.text)) for r in docs.collect())


def test_filters_lose_nothing(spark):
    """Lines that share random parts of the templates, around the threshold."""
    rng = random.Random(5)
    lines = []
    for i in range(1, 301):
        _, t = rng.choice(li.TEMPLATES)
        words = [w for w in t.split() if rng.random() < 0.85] + rng.choices(["the", "of", "zebra", "License"], k=rng.randrange(5))
        rng.shuffle(words)
        lines.append((i, " ".join(words)))
    docs = spark.createDataFrame(lines, "doc_id bigint, text string")
    expected = sorted((i, brute(t)) for i, t in lines)
    assert rows_of(li.scan(docs)) == expected
    assert 50 < sum(x[1][6] > 0 for x in expected) < 290


def test_phrases(spark):
    cases = ["GNU General Public License", "the MIT--License, mit license", "cc by cc by", "apache LICENSEé", "CC\nBY", "gnu general public"]
    docs = spark.createDataFrame(list(enumerate(cases, 1)), "doc_id bigint, text string")
    assert rows_of(li.scan(docs)) == sorted((i, brute(t)) for i, t in enumerate(cases, 1))


def test_native(docs, odd_docs, spread):
    plan = li.scan(spread(odd_docs))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "NestedLoop" not in text and "Cartesian" not in text
    assert plan.count() == odd_docs.count()
