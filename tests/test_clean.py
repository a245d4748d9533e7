"""The cleaning job on hand-written NDJSON."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from paperweave.operators.order import chunk_ranges, dense_row_index, row_slice
from paperweave.plans import clean
from paperweave.sources import papers as source


def paper(id_, **fields):
    base = {"id": id_, "title": "T", "abstract": "A", "categories": "cs.AI",
            "versions": [{"version": "v1", "created": "Mon, 2 Apr 2007 19:18:42 GMT"}],
            "authors_parsed": [["Last", "First", ""]], "license": None, "extra": 1}
    return {**base, **fields}


def write(folder, rows, name="part-0.json"):
    folder.mkdir(exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in rows]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(folder)


def run(spark, tmp_path, path):
    target = clean.run(spark, path, str(tmp_path / "clean.parquet"))
    return source.read_papers(spark, target).orderBy("row_idx").collect()


def test_rules(spark, tmp_path):
    path = write(tmp_path / "raw", [
        paper("1", title=" A\n\tb 　c ", categories="math.CO cs.LG"),
        paper("2", categories="cs.LGX cs.L"),
        paper("3", categories=None), paper("4", categories=""),
        paper("5", categories="x  cs.RO"),
        paper("1", title="later copy"),
        paper(None, title="first null"), paper(None, title="second null"),
        paper("6", versions=[]), paper("7", versions=None),
        paper("8", versions=[{"version": "v1", "created": "bad"},
                             {"version": "v2", "created": "Tue, 03 Apr 2007 01:02:03 GMT"}]),
        paper("9", authors_parsed=[["Yuan", "C.", "Jr"], ["Li", "D."]]),
        {"id": "10", "categories": "cs.CL"},
    ])
    rows = run(spark, tmp_path, path)
    assert [r["row_idx"] for r in rows] == list(range(len(rows)))
    assert [r["id"] for r in rows] == ["1", "5", None, "6", "7", "8", "9", "10"]
    first = rows[0]
    assert first["title"] == "A b c"
    assert first["categories_parsed"] == ["math.CO", "cs.LG"]
    assert first["last_submitted"] == dt.datetime(2007, 4, 2, 19, 18, 42)
    assert rows[1]["categories_parsed"] == ["x", "", "cs.RO"]
    assert rows[2]["title"] == "first null"
    assert rows[3]["last_submitted"] is None and rows[4]["last_submitted"] is None
    assert rows[5]["last_submitted"] == dt.datetime(2007, 4, 3, 1, 2, 3)
    assert rows[6]["authors_parsed"] == ["Jr C. Yuan", "D. Li"]
    assert rows[7]["title"] is None
    assert first.asDict().keys() == {"row_idx", *clean.CLEAN_COLUMNS}


def test_first_copy_follows_file_order(spark, tmp_path):
    path = write(tmp_path / "raw", [paper("1", title="old"), paper("2")], "a.json")
    write(tmp_path / "raw", [paper("3"), paper("1", title="new")], "b.json")
    assert [(r["id"], r["title"]) for r in run(spark, tmp_path, path)] == [("1", "old"), ("2", "T"), ("3", "T")]


def test_wrong_weekday_fails(spark, tmp_path):
    path = write(tmp_path / "raw", [
        paper("1", versions=[{"version": "v1", "created": "Fri, 2 Apr 2007 19:18:42 GMT"}])])
    with pytest.raises(Exception, match="not a valid date"):
        run(spark, tmp_path, path)


def test_malformed_line(spark, tmp_path):
    path = write(tmp_path / "raw", [paper("1"), '{"id": "2", "categories": ', paper("3")])
    with pytest.raises(Exception):
        source.read_raw_papers(spark, path).collect()
    lenient = source.read_raw_papers(spark, path, strict=False).cache()
    assert lenient.filter("_corrupt is not null").count() == 1
    assert {r["id"] for r in lenient.filter("_corrupt is null").collect()} == {"1", "3"}


def test_paths():
    assert source.default_clean_path("/d/raw.json") == "/d/raw-clean.parquet"
    with pytest.raises(ValueError):
        source.require_suffix("/d/raw.csv", ".json")
    with pytest.raises(ValueError):
        source.require_suffix("/d/out.csv", ".parquet")


@pytest.mark.parametrize("partitions", [1, 3, 11])
def test_dense_numbers(spark, partitions):
    # A third of the rows share one key, and some keys are null.
    rows = [("hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i % 50:02}", i) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, i bigint").repartition(5)
    got = dense_row_index(df, ["k", "i"], start=5, partitions=partitions).orderBy("row_idx").collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert [(r["k"], r["i"]) for r in got] == want
    assert [r["row_idx"] for r in got] == list(range(5, 1005))


def test_dense_numbers_of_nothing(spark):
    assert dense_row_index(spark.range(0), ["id"]).count() == 0


def test_chunks_and_slices(spark):
    numbered = spark.range(25).withColumnRenamed("id", "n")
    chunks = chunk_ranges(numbered, "n", 10).orderBy("chunk").collect()
    assert [tuple(r) for r in chunks] == [(0, 0, 10, 10), (1, 10, 20, 10), (2, 20, 25, 5)]
    assert [r["n"] for r in row_slice(numbered, "n", 20, 10).collect()] == [20, 21, 22, 23, 24]


def test_numbers_when_the_session_limits_files(spark):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "10")
    try:
        got = dense_row_index(spark.range(100).select((F.lit(100) - F.col("id")).alias("k")), ["k"], partitions=3).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert sorted((r["k"], r["row_idx"]) for r in got) == [(k + 1, k) for k in range(100)]
