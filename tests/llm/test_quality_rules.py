import re
from collections import Counter

import pytest

from paperweave.llm import quality_rules as q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


@pytest.mark.parametrize("which", ["odd_docs", "docs"])
def test_measures(request, which):
    for r in q.judge(request.getfixturevalue(which)).collect():
        n_words, _, _, _, repeated = expected = brute(r.text)
        assert tuple(r[c] for c in q.BASE) == expected
        assert r.base_failed == (n_words < 20 or 100 * repeated > 30 * n_words)
        assert r.kept == (not r.base_failed and not r.broken)


def test_windows_at_the_limits(spark):
    words = [f"w{i}" for i in range(9)]
    cases = [" ".join(words[:8]), " ".join(words[:8] * 2), " ".join(["a"] * 9), " ".join(words[:8] + ["x"] + words[:8])]
    rows = q.measure(spark.createDataFrame(list(enumerate(cases)), "doc_id int, text string")).collect()
    assert [r.n_repeat_words for r in sorted(rows)] == [brute(c)[4] for c in cases] == [0, 16, 9, 16]


def test_rules_and_thresholds(spark):
    good = "The cat of the house and the dog of the yard sat in the sun as it was by now."
    cases = {"good": good, "symbols": good.replace(" ", "# "), "stop": " ".join(f"zz{i}" for i in range(30)),
             "lines": good + "\nsame" * 20}
    kept = {r.name: (r.kept, list(r.broken)) for r in q.judge(
        spark.createDataFrame(list(cases.items()), "name string, text string")).collect()}
    assert kept["good"] == (True, [])
    assert kept["symbols"][1] and not kept["symbols"][0] and "symbols per word" in kept["symbols"][1]
    assert kept["stop"] == (False, ["stop words per word"])
    assert "repeated lines" in kept["lines"][1]


def test_one_projection(docs):
    plan = q.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_labelled_documents(spark):
    """Clean documents stay; most of the bad ones go."""
    folder = "/root/testdata/sf0.01"
    rows = q.judge(spark.read.parquet(f"{folder}/documents.parquet")).join(
        spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("n_words >= 20").select("kept", "quality").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.05


def test_keep_good(odd_docs, no_docs, spread):
    wide = spread(odd_docs)
    kept = q.keep_good(wide)
    assert kept.columns == wide.columns and sorted(r.doc_id for r in kept.collect()) == [1, 7, 7]
    assert q.keep_good(no_docs).count() == 0 and q.judge(no_docs).count() == 0
    with pytest.raises(ValueError, match="named like measures"):
        q.judge(odd_docs.withColumnRenamed("source", "N_words"))
    with pytest.raises(ValueError, match="missing"):
        q.judge(odd_docs.drop("text"))
