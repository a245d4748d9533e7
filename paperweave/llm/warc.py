"""WARC archives with revisit records.

Headers are shuffled by payload digest; the first page of a digest is the
response and later ones become revisit records that refer to it, without a
payload. Records are rows of text, so Spark writes the archives itself, gzip
compressed, one or more for each of its partitions. Archives are read back one
at a time in tasks, by their Content-Length, and revisit records are joined to
their responses.

Defined results: a null html is an empty payload. Payloads below
``LEAST_BYTES`` are never shared. Rows with the smallest id of a digest are all
responses, repeated rows too; rows without an id refer to the smallest id if
there is one. Null or odd urls lose line ends or are left out. An empty table
gives an empty one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperweave.llm.common import need, quoted

LEAST_BYTES = 100
MOST_RECORDS = 20_000  # of an archive
END = "\r\n"
RECORDS = "page_id bigint, record_type string, url string, digest string, refers_to bigint, payload_bytes bigint, found_digest string"


def with_digests(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, html, bytes, digest) of every page."""
    need(pages, id_column, html)
    address = quoted(url).cast("string") if url in pages.columns else F.lit(None).cast("string")
    return pages.select(
        quoted(id_column).cast("bigint").alias("page_id"), address.alias("url"),
        F.coalesce(quoted(html), F.lit("")).alias("html")).withColumns({
            "bytes": F.octet_length("html").cast("bigint"), "digest": F.sha2("html", 256)})


def first_pages(pages: DataFrame) -> DataFrame:
    """(digest, first) of payloads that may be shared; combined before the shuffle."""
    return pages.filter(F.col("bytes") >= LEAST_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"))


def resolved(pages: DataFrame) -> DataFrame:
    """Pages with ``record_type`` and ``refers_to``. Only headers move by digest."""
    heads = pages.select("page_id", "bytes", "digest")
    decided = heads.join(first_pages(pages), "digest").filter(
        (F.col("bytes") >= LEAST_BYTES) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")))
    revisits = decided.select("page_id", "digest", F.col("first").alias("refers_to")).distinct()
    return _with_target(pages, revisits)


def _with_target(pages: DataFrame, revisits: DataFrame) -> DataFrame:
    r = revisits.select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), "refers_to")
    joined = pages.join(r.hint("merge"), F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left")
    return joined.withColumn("record_type", F.when(F.col("r_digest").isNull(), "response").otherwise("revisit")).drop(
        "r_id", "r_digest")


def record_text() -> Column:
    """A WARC/1.1 record whose last line end is the one that the text writer adds."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.col("bytes"), F.lit(END + END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))

    def field(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(END))).otherwise(F.lit(""))

    def page_urn(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))

    address = F.nullif(F.trim(F.regexp_replace("url", "[\\x00-\\x20]+", " ")), F.lit(""))
    return F.concat(
        F.lit(f"WARC/1.1{END}"), field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", F.coalesce(page_urn(F.col("page_id")), F.lit("<urn:page:>"))),
        field("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        field("WARC-Target-URI", address), field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        field("WARC-Refers-To", page_urn(F.col("refers_to"))),
        F.when(revisit, F.lit(
            f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{END}")).otherwise(""),
        F.lit(f"Content-Type: application/http;msgtype=response{END}Content-Length: "),
        F.octet_length(block), F.lit(END + END), block, F.lit(f"{END}\r"))


def write_archives(rows: DataFrame, path: str) -> None:
    """Write resolved pages as archives, one or more a task, so their size follows Spark's partitions."""
    rows.select(record_text().alias("value")).write.option("compression", "gzip").option(
        "maxRecordsPerFile", MOST_RECORDS).text(path)


def records_in(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a gzip archive; unpacked piece by piece."""
    unzip, held, at = zlib.decompressobj(31), bytearray(), 0
    view = memoryview(data)

    def more() -> bool:
        nonlocal at, unzip
        while at < len(view):
            held.extend(unzip.decompress(view[at:at + (1 << 18)]))
            at += 1 << 18
            if unzip.eof:
                at = min(at, len(view)) - len(unzip.unused_data)
                unzip = zlib.decompressobj(31)
            return True
        return False

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held.strip():
                    raise ValueError("archive ends inside a header")
                return
        lines = held[:end].decode().split(END)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record: {lines[0][:80]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(headers["content-length"])
        while len(held) < end + 8 + size:
            if not more():
                raise ValueError("archive ends inside a record")
        block = bytes(held[end + 4:end + 4 + size])
        del held[:end + 8 + size]
        yield headers, block


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record: its headers, and length and digest of the payload found in it."""
    import hashlib

    def page(urn: str | None) -> int | None:
        inner = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(inner) if inner else None

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split(" ")[0] for f in RECORDS.split(", ")]
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for headers, block in records_in(content.as_py()):
                    payload = block.partition(b"\r\n\r\n")[2]
                    rows.append((
                        page(headers.get("warc-record-id")), headers.get("warc-type"), headers.get("warc-target-uri"),
                        headers.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                        page(headers.get("warc-refers-to")), len(payload), hashlib.sha256(payload).hexdigest()))
                columns = list(zip(*rows)) if rows else [[] for _ in names]
                types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(parse, RECORDS)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Records with the full payload's length and digest; revisit records take those of their response."""
    kept = records.filter("record_type = 'response'").groupBy("found_digest").agg(
        F.max("payload_bytes").alias("r_bytes"))
    joined = records.join(kept.withColumnRenamed("found_digest", "r_digest"),
                          (F.col("digest") == F.col("r_digest")) & (F.col("record_type") == "revisit"), "left")
    return joined.select(
        "page_id", F.coalesce("r_bytes", F.when(F.col("record_type") == "response", F.col("payload_bytes"))).alias("payload_bytes"),
        F.coalesce("r_digest", F.when(F.col("record_type") == "response", F.col("found_digest"))).alias("payload_digest"),
        "record_type", "refers_to", "url")
