import random

import pytest

from paperweave.llm import line_templates as lt


def brute(docs):
    """Every pair of lines of a leaf by the rule: equal, or enough words outside the segments in which they differ."""
    lines = [(i, n, words) for i, text in docs for n, line in enumerate(text.split("\n")) if (words := lt.parsed(line))]
    leaves = {}
    for i, n, words in lines:
        leaves.setdefault((len(words), *words[:3]), []).append((i, n, words))
    gone = set()
    for (size, *_), members in leaves.items():
        segment = {}
        if size > 3:
            parts = min(7, size - 3)
            for part in range(parts):
                for place in range(3 + part * (size - 3) // parts, 3 + (part + 1) * (size - 3) // parts):
                    segment[place] = part
        for i, n, words in members:
            for j, _, other in members:
                if j >= i:
                    continue
                differ = {segment[p] for p in range(3, size) if words[p] != other[p]}
                same = [w for p, w in enumerate(words) if segment.get(p) not in differ and w != lt.FIELD]
                if not differ or len(same) * 10 >= 7 * size:
                    gone.add((i, n))
                    break
    return gone


def dropped(docs_df):
    return {(r.id, n) for r in lt.recurring(docs_df).collect() for n in r.lines}


def test_given_documents(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = brute(rows)
    assert expected and dropped(docs) == expected


def test_fields_and_similar_lines(spark):
    boiler = "Posted by user number {} on the public forum of the site"
    rows = [(i, f"Own words of page {w} that nobody else uses here ever.\n" + boiler.format(i * 7)) for i, w in enumerate("abcdef")]
    rows += [(10, "Read our terms of use and the privacy policy before Monday comes"),
             (11, "Read our terms of use and the privacy policy before Friday comes"),
             (12, "Read our terms and nothing of the rest is like the other line")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = dropped(df)
    assert {(i, 1) for i in range(1, 6)} <= found and (11, 0) in found and (10, 0) not in found and (12, 0) not in found
    after = {r.doc_id: r.text for r in lt.drop_lines(df).collect()}
    assert after[0] == rows[0][1] and after[11] == ""
    assert {r.doc_id for r in lt.without_emptied(df).collect()} == {r[0] for r in rows} - {11} - {i for i in range(1, 6) if (i, 0) in found}


def random_lines(seed, n_docs):
    rng = random.Random(seed)
    out = []
    for i in range(n_docs):
        lines = []
        for _ in range(rng.randint(1, 3)):
            n = rng.choice([6, 7, 10, 11, 13, 20, 31])
            words = [f"{chr(97 + k % 26)}{'x' * (k // 26)}" for k in range(n)]
            for k in rng.sample(range(n), rng.randint(0, n // 3)):
                words[k] = rng.choice(["one", "two", "three", "4", "55"])
            lines.append(" ".join(words))
        out.append((i, "\n".join(lines)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_that_vary_in_several_places(spark, seed, monkeypatch):
    monkeypatch.setattr(lt, "PARTS", 1 + seed)
    rows = random_lines(seed, 250)
    found = dropped(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert found == brute(rows) and 0 < len(found) < sum(t.count("\n") + 1 for _, t in rows)


def test_one_rule_at_every_size(spark):
    """A leaf of 6,000 bodies: more documents behind change nothing for those before them."""
    rng = random.Random(3)
    rows = [(i, "The same start of a line " + " ".join(rng.choice("abcdefghij") for _ in range(9))) for i in range(6000)]
    found = {n: dropped(spark.createDataFrame(rows[:n], "doc_id bigint, text string")) for n in (300, 6000)}
    assert found[300] == {x for x in found[6000] if x[0] < 300} == brute(rows[:300])


def test_templates_of_a_line():
    """Sets of segments that are as large as can be, of at most three tenths of the places."""
    assert len(lt.template_hashes("a b c d e f".split(), 1)) == 3
    assert len(lt.template_hashes("a b c d e f g h i j".split(), 1)) == 35
    assert len(lt.template_hashes(["w"] * 100, 1)) == 21
    # A field in a segment is not a word that stays, so fewer others may vary.
    assert len(lt.template_hashes(f"a b c d e {lt.FIELD}".split(), 1)) == 1


def test_short_lines_recur_as_they_are(spark):
    rows = [(i, "All rights reserved.\nMenu\n这是一个在所有文件里都重复的很长的句子。\nPage 12 of 13") for i in (1, 2)]
    rows.append((3, "All rights  reserved.\nAll rights reserved!"))
    assert dropped(spark.createDataFrame(rows, "doc_id bigint, text string")) == {(2, 0), (2, 2), (3, 0)}


def test_short_lines_and_repeats_inside_stay(spark):
    rows = [(1, "Short line here\n" * 3), (2, "Short line here"), (3, "a line of six words here\na line of six words here")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert dropped(df) == set()


def test_odd_rows(odd_docs, no_docs, spread):
    wide = spread(odd_docs)
    out = lt.drop_lines(wide, count="lost")
    assert out.columns == wide.columns + ["lost"] and out.count() == wide.count()
    after = {r.doc_id: r for r in out.collect()}
    assert after[2].text is None and after[None].text == "no id here at all" and after[7].lost == 1 and after[1].lost == 0
    assert after[7].text == "A line.\nA line."
    assert lt.without_emptied(wide).columns == wide.columns
    assert lt.drop_lines(no_docs).count() == 0


def test_lines_of_numbers_recur_only_as_they_are(spark):
    """Different rows of figures are no template; equal ones still recur, and few numbers still vary."""
    rows = [(1, "1 2 3 4 5 6 7\n2024-01-01 10:00:00 GET /a1 200 17 ok"), (2, "1 2 3 4 5 6 8\n2024-01-02 11:30:00 GET /b2 404 99 ok"),
            (3, "8 9 10 11 12 13 14"), (4, "1  2 3 4 5 6 7"), (5, "Page 4 of the long report about the trees"),
            (6, "Page 5 of the long report about the trees")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert dropped(df) == {(4, 0), (6, 0)}
    assert {r.doc_id for r in lt.without_emptied(df).collect()} == {1, 2, 3, 5}
