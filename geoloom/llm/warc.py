"""WARC archives that hold every payload once.

Pages are hashed, their headers grouped by payload digest, and each page whose payload of
at least ``LEAST_BYTES`` bytes is also that of a page with a smaller id becomes a revisit
record of that page's response.  Only digests that occur more than once are joined back,
and a digest that many pages share is split by adaptive execution, as only the page side is
large.  Records are written as gzipped text with the record separator between them, at
most ``records`` to an archive.  Reading parses archives by their content lengths and joins
revisits to the responses by digest, which gives each its full payload's size.

A null payload is empty.  Pages without an id are written as responses and never referred
to; repeated rows of the smallest id are all responses.  Line ends in a URL are
percent-encoded, a null URL has no header.  An empty table gives no record; extra columns
are ignored.
"""

from __future__ import annotations

import datetime
import hashlib
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.common import column, map_rows

LEAST_BYTES = 100
RECORDS = 20_000
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def resolved(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, html, payload_bytes, payload_digest, original): ``original`` is the response's (page_id, url) for revisits."""
    rows = pages.select(
        column(pages, "page_id").cast("bigint").alias("page_id"), column(pages, "url").alias("url"),
        F.coalesce(column(pages, "html"), F.lit("")).alias("html"),
    )
    hashed = rows.withColumns({"payload_bytes": F.octet_length("html").cast("bigint"), "payload_digest": F.sha2("html", 256)})
    shared = (
        hashed.filter(F.col("payload_bytes") >= least_bytes).filter("page_id is not null")
        .groupBy("payload_digest").agg(F.count("*").alias("n"), F.min(F.struct("page_id", "url")).alias("original"))
        .filter("n > 1").drop("n")
    )
    revisit = (F.col("payload_bytes") >= least_bytes) & (F.col("page_id") > F.col("original.page_id"))
    return hashed.join(shared, "payload_digest", "left").withColumn("original", F.when(revisit, F.col("original")))


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _uri(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def _url(url: Column) -> Column:
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def records(pages: DataFrame, date: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(record): a record's text without the separator that ends it."""
    r = resolved(pages, least_bytes)
    old = F.col("original")
    again = old.isNotNull()
    text = F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        _header("WARC-Record-ID", _uri(F.col("page_id"))), _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", _url(F.col("url"))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _header("WARC-Refers-To", F.when(again, _uri(old["page_id"]))),
        _header("WARC-Refers-To-Target-URI", F.when(again, _url(old["url"]))),
        _header("WARC-Profile", F.when(again, F.lit(PROFILE))),
        _header("Content-Type", F.when(~again, F.lit("text/html; charset=utf-8"))),
        _header("Content-Length", F.when(again, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
        F.lit("\r\n"), F.when(again, F.lit("")).otherwise(F.col("html")),
    )
    return r.select(text.alias("record"))


def write(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, per_archive: int = RECORDS) -> None:
    date = datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    out = records(pages, date, least_bytes).write
    out.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", per_archive).text(path)


def _inflated(raw: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The content of a gzip file of one or more members, piece by piece."""
    left = memoryview(raw)
    while len(left):
        member = zlib.decompressobj(zlib.MAX_WBITS | 16)
        while not member.eof and len(left):
            piece, left = left[:step], left[step:]
            data = member.decompress(piece)
            if data:
                yield data
            if member.eof and member.unused_data:
                left = memoryview(member.unused_data + bytes(left))


def parsed(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of every record."""
    buffer = bytearray()

    def fill(n: int) -> bool:
        while len(buffer) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            buffer.extend(piece)
        return True

    while fill(1):
        at = 0
        while (end := buffer.find(b"\r\n\r\n", max(0, at - 3))) < 0:
            at = len(buffer)
            if not fill(at + 1):
                raise ValueError("an archive ends inside a header")
        lines = buffer[:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record where one should begin: {lines[0][:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start, size = end + 4, int(headers["content-length"])
        if not fill(start + size + 4):
            raise ValueError("an archive ends inside a block")
        block = bytes(buffer[start : start + size])
        del buffer[: start + size + 4]
        yield headers, block


def read(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record_type, payload_digest, size, refers_to, url, ok): the archives' records.

    ``ok`` tells whether the block has the digest its header states; a revisit has no block.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")

    def number(uri: str | None) -> int | None:
        text = (uri or "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text else None

    def make():
        def rows(contents):
            for raw in contents:
                for h, block in parsed(_inflated(raw)):
                    digest = h["warc-payload-digest"].removeprefix("sha256:")
                    again = h["warc-type"] == "revisit"
                    ok = again or hashlib.sha256(block).hexdigest() == digest
                    yield number(h["warc-record-id"]), h["warc-type"], digest, None if again else len(block), number(h.get("warc-refers-to")), h.get("warc-target-uri"), ok

        return rows

    return map_rows(
        files, make, "page_id bigint, record_type string, payload_digest string, size bigint, refers_to bigint, url string, ok boolean",
        rows_per_step=1,
    )


def resolve_revisits(recs: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url, ok): revisits take the size of the response they refer to."""
    first = recs.filter("record_type = 'response' and page_id is not null").select(
        F.col("payload_digest").alias("d"), F.col("page_id").alias("o"), F.col("size").alias("full")
    ).dropDuplicates(["d", "o"])
    on = (F.col("payload_digest") == F.col("d")) & (F.col("refers_to") == F.col("o"))
    return recs.join(first, on, "left").select(
        "page_id", F.coalesce("size", "full").alias("payload_bytes"), "payload_digest", "record_type", "refers_to", "url",
        (F.col("ok") & ((F.col("record_type") == "response") | F.col("full").isNotNull())).alias("ok"),
    )


ORACLE = """SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest,
  CASE WHEN strlen(h) >= 100 AND page_id > m THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN strlen(h) >= 100 AND page_id > m THEN m END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS m FROM pages)"""
