import gzip
import hashlib
from pathlib import Path

import pytest

from paperweave.llm import warc as w
from paperweave.workspace import new_path

BIG = "<p>Grüße</p>\r\n\r\nWARC/1.1\r\n" * 20
PAGES = [
    (5, "http://a/\r\nX: y", BIG), (3, "http://b/", BIG), (9, None, BIG), (9, None, BIG), (1, "", "small"), (2, "u", "small"),
    (4, "u", None), (6, "u", ""), (None, "u", BIG), (7, "u", "x" * 99), (8, "u", "x" * 99), (10, "u", "y" * 100), (11, "u", "y" * 100),
    (None, "u", "only without id" * 10), (12, "u", "long " * 200_000), (3, "http://b/", BIG),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id bigint, url string, html string")


def expected(rows):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        of = first.get(html or "")
        again = len(data) >= 100 and of is not None and of != i
        out.append((i or -1, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", of if again else -1))
    return sorted(out)


def round_trip(spark, pages):
    path = new_path(spark, "warc-test")
    w.write_archives(w.resolved(w.with_digests(pages)), path)
    return path, w.resolve_revisits(w.read_archives(spark, path))


def test_round_trip(spark, pages):
    _, found = round_trip(spark, pages)
    assert sorted((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or -1)
                  for r in found.collect()) == expected(PAGES)


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    twice = pages.unionByName(pages.selectExpr("page_id + 1000 as page_id", "url", "html"))
    rows = [tuple(r) for r in twice.select("page_id", "url", "html").collect()]
    _, found = round_trip(spark, twice)
    assert sorted((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to if r.refers_to is not None else -1)
                  for r in found.collect()) == sorted(
        (i or -1, n, d, t, f) for i, n, d, t, f in expected_zero(rows))


def expected_zero(rows):
    """As ``expected`` with page 0, which is a real id here."""
    return [((i - 1) or -1, n, d, t, f - 1 if f > 0 else -1) for i, n, d, t, f in expected(
        [(i + 1, u, h) for i, u, h in rows])]


def test_archives_are_warc(spark, pages):
    """Payloads lie once in the files, headers are whole and urls can't add lines."""
    path, _ = round_trip(spark, pages)
    files = list(Path(path.removeprefix("file:")).glob("*.gz"))
    data = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert data.count(BIG.encode()) == 2  # page 3 is there twice
    assert b"WARC-Target-URI: http://a/ X: y\r\n" in data and b"\r\nX: y" not in data
    assert data.count(b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest") == 5
    records = [r for f in files for r in w.records_in(f.read_bytes())]
    assert len(records) == len(PAGES)
    assert all(h["content-type"] == "application/http;msgtype=response" for h, _ in records)


def test_damaged_archive():
    whole = gzip.compress(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc")
    with pytest.raises(ValueError, match="ends inside a record"):
        list(w.records_in(whole))
    with pytest.raises(ValueError, match="no WARC record"):
        list(w.records_in(gzip.compress(b"HTTP/1.1 200\r\n\r\n")))


def test_members_of_one_file():
    """Archives with a gzip member per record read alike."""
    record = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in w.records_in(gzip.compress(record) * 3)] == [b"abc"] * 3


def test_empty_and_clashing(spark, pages, spread):
    _, found = round_trip(spark, pages.limit(0))
    assert found.count() == 0
    _, found = round_trip(spark, spread(pages))
    assert found.count() == len(PAGES)
