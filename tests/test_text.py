"""Column rules on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from paperweave.functions import naming, text, tokens
from paperweave.sources import papers


def one(spark, column, **values):
    """Value of a column over one row of string (or given) values."""
    row = spark.range(1).select(*[(v if hasattr(v, "alias") else F.lit(v)).alias(k) for k, v in values.items()])
    return row.select(column.alias("out")).first()["out"]


@pytest.mark.parametrize("raw,want", [
    ("a\nb", "a b"), ("  a \t b\n", "a b"), ("a 　b", "a b"), (" a ", "a"),
    ("", ""), (" \n ", ""), ("a​b", "a​b"), ("a\x85b\x0bc", "a b c")])
def test_collapse_spaces(spark, raw, want):
    assert one(spark, text.collapse_spaces(F.col("t")), t=raw) == want


def test_strip_spaces_keeps_inside(spark):
    assert one(spark, text.strip_spaces(F.col("t")), t="　 a  b\n \n") == "a  b"


def test_split_keeps_empty_parts(spark):
    assert one(spark, text.split_words(F.col("t")), t="a  b ") == ["a", "", "b", ""]
    assert one(spark, text.split_words(F.col("t")), t="") == [""]


@pytest.mark.parametrize("parts,want", [
    (["Yuan", "C.", "Jr"], "Jr C. Yuan"), (["Yuan", "C.", ""], "C. Yuan"),
    (["Yuan", None, "Jr"], "Jr Yuan"), ([], ""), (["A  B", "C"], "C A  B")])
def test_reversed_name(spark, parts, want):
    df = spark.createDataFrame([(parts,)], "p array<string>")
    assert df.select(text.reversed_name(F.col("p"))).first()[0] == want


def test_display_names_keep_null_lists(spark):
    df = spark.createDataFrame([([["A", "B"], None],), (None,)], "p array<array<string>>")
    assert [r[0] for r in df.select(text.display_names(F.col("p"))).collect()] == [["B A", None], None]


def test_last_item(spark):
    df = spark.createDataFrame([([1, 2],), ([],), (None,)], "a array<int>")
    assert [r[0] for r in df.select(text.last_item(F.col("a"))).collect()] == [2, None, None]


def test_concat_fields_needs_all(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None)], "x string, y string")
    assert [r[0] for r in df.select(text.concat_fields(F.col("x"), F.col("y"))).collect()] == ["a\n\nb", None, None]


@pytest.mark.parametrize("raw,want", [
    ("Mon, 2 Apr 2007 19:18:42 GMT", dt.datetime(2007, 4, 2, 19, 18, 42)),
    ("Mon, 02 Apr 2007 19:18:42 GMT", dt.datetime(2007, 4, 2, 19, 18, 42)), (None, None)])
def test_http_date(spark, raw, want):
    value = F.lit(raw).cast("string")
    assert one(spark, text.parse_http_date(F.col("t")), t=value) == want


@pytest.mark.parametrize("raw", [
    "Tue, 2 Apr 2007 19:18:42 GMT", "2 Apr 2007 19:18:42 GMT", "Mon, 2 Apr 2007 19:18:42 UTC", "x", ""])
def test_http_date_is_strict(spark, raw):
    with pytest.raises(Exception):
        one(spark, text.parse_http_date(F.col("t")), t=raw)
    assert one(spark, text.parse_http_date(F.col("t"), strict=False), t=raw) is None


@pytest.mark.parametrize("strict", [True, False])
def test_http_date_ignores_session_zone(spark, strict):
    # This hour does not exist on New York clocks.
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = one(spark, text.parse_http_date(F.col("t"), strict), t="Sun, 11 Mar 2007 02:30:00 GMT")
        assert got == dt.datetime(2007, 3, 11, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("raw,want", [
    ("Two words", 3), ("1234567", 3), ("a1b", 3), ("é, né!", 4), ("", 0), (" \n", 1), ("éx", 1), ("日本", 2),
    ("中文字" * 2000, 6000), ("ภาษาไทย" * 500, 3500), ("a" * 4001, 1001), ("ab日本", 1), ("日本ab", 3)])
def test_token_count(spark, raw, want):
    assert one(spark, tokens.token_count(F.col("t")), t=raw) == want


@pytest.mark.parametrize("path,want", [
    ("a/b/raw.json", "a/b/raw-clean.parquet"), ("raw.json", "raw-clean.parquet"),
    ("s3a://bucket/x/raw.json", "s3a://bucket/x/raw-clean.parquet"), ("hdfs:///x.y/raw", "hdfs:///x.y/raw-clean.parquet"),
    (".hidden", ".hidden-clean.parquet")])
def test_default_clean_path(path, want):
    assert papers.default_clean_path(path) == want


def test_tokenizer_count(spark):
    count = tokens.tokenizer_count(lambda: lambda t: t.split("-"))
    df = spark.createDataFrame([("a-b-c",), (None,), ("x",)], "t string")
    assert [r[0] for r in df.select(count(F.col("t"))).collect()] == [3, None, 1]


def test_names(spark):
    n = {k: F.lit(v) for k, v in (("job", 12345), ("batch", 2), ("file", 0))}
    assert one(spark, naming.zero_pad(F.col("job"), 4), **n) == "12345"
    assert one(spark, naming.custom_id(F.lit(1), F.lit(2), F.lit(1234567)), **n) == "batch-0001-00002-request-1234567"
    name = naming.batch_file_name(F.lit("Org/Big-Model"), F.lit(1), F.col("batch"), F.col("file"))
    assert one(spark, name, **n) == "big-model-0001-batch-0002.jsonl"
    n["file"] = F.lit(3)
    assert one(spark, name, **n) == "big-model-0001-batch-0002_3.jsonl"
    assert one(spark, naming.result_file_name(F.lit("d.x/e/m.jsonl")), **n) == "d.x/e/m_result.jsonl"
    assert one(spark, naming.result_file_name(F.lit("m.jsonl")), **n) == "m_result.jsonl"
    assert one(spark, naming.drop_last_parts(F.lit("a-b-0001-batch")), **n) == "a-b"
    assert one(spark, naming.drop_last_parts(F.lit("a")), **n) == ""
    assert one(spark, naming.or_null_word(F.lit("")), **n) == "Null"
    assert one(spark, naming.unix_time(F.lit(0)), **n).timestamp() == 0


def test_as_utc_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        moment = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        assert one(spark, F.unix_seconds(naming.as_utc(moment)), x=1) == 1704067200
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
