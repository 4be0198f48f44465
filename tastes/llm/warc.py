"""WARC archives: write, read back, and resolve revisits of equal payloads.

Only headers are shuffled to decide: (payload digest, id) of payloads of at
least `min_bytes` bytes, grouped by digest; the largest id of a group is the
response, the others become revisit records that carry headers only and name
the response. The decision joins the records by digest (both sides are
scans, so a digest of a third of all records is split), and the archives are
written with fresh headers: a record a row of Spark's text writer, whose
line end is the one that ends a WARC record, compressed, in files of about
`FILE_BYTES` of payload. Reading takes every file apart by the records'
lengths, checks the digests of responses, and joins revisits to the response
that they name.

Null payloads are empty. Records without an id are never a response that
others name; alone in their group they are responses. Records that repeat
the largest id of a group are all responses. Control characters and blanks
in URLs are percent-encoded in headers. An empty table writes no record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastes.llm.common import Scratch

MIN_BYTES = 1000
FILE_BYTES = 8_000_000
# Line end, the end of a record, and the profile of a revisit.
CRLF = "\r\n"
RECORD_END = CRLF + CRLF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "

_RECORD = (
    "page_id long, url string, record_type string, record_id string, refers_to_record string, "
    "payload_digest string, payload_bytes long, payload binary"
)


def base32_of_hex(digest: Column) -> Column:
    """Base32 (RFC 4648) of a 40-digit hexadecimal column."""
    parts = [
        F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)
    ]
    return F.translate(
        F.upper(F.concat(*parts)),
        "0123456789ABCDEFGHIJKLMNOPQRSTUV",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    )


def _record_id(page_id: Column, digest: Column) -> Column:
    md5 = F.md5(F.concat_ws("|", page_id.cast("string"), digest).cast("binary"))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(
        F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(md5, a, n) for a, n in cuts)), F.lit(">")
    )


def _header(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def plan_records(pages: DataFrame, scratch: Scratch, min_bytes: int = MIN_BYTES) -> DataFrame:
    """The response of every payload that comes more than once: digest, original."""
    headers = scratch.save(
        pages.select("page_id", F.coalesce("html", F.lit("")).alias("payload")).select(
            "page_id",
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.sha1("payload").alias("digest"),
        ),
        "headers",
    )
    return scratch.save(
        headers.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and original is not null")
        .select("digest", "original"),
        "originals",
    )


def write_archives(
    pages: DataFrame, path: str, scratch: Scratch, min_bytes: int = MIN_BYTES,
    written: str = "2024-01-01T00:00:00Z",
) -> None:
    """Writes one record per row of `pages` (page_id, url, html) under `path`."""
    originals = plan_records(pages, scratch, min_bytes)
    records = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce("html", F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    records = records.join(originals, "digest", "left")
    size = F.octet_length("payload")
    revisit = (
        (size >= min_bytes)
        & F.col("original").isNotNull()
        & ~F.col("page_id").eqNullSafe(F.col("original"))
    )
    address = F.regexp_replace(
        F.regexp_replace(F.regexp_replace("url", " ", "%20"), "\r", "%0D"), "\n", "%0A"
    )
    http = F.concat(F.lit(_HTTP), size.cast("string"), F.lit(RECORD_END))
    block_bytes = F.octet_length(http) + F.when(revisit, 0).otherwise(size)
    original_id = F.when(revisit, _record_id(F.col("original"), F.col("digest")))
    head = F.concat(
        F.lit("WARC/1.1" + CRLF),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _header("WARC-Date", F.lit(written)),
        _header("WARC-Target-URI", address),
        _header("X-Page-Id", F.col("page_id").cast("string")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("digest")))),
        _header("WARC-Refers-To", original_id),
        _header("WARC-Profile", F.when(revisit, PROFILE)),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", block_bytes.cast("string")),
        F.lit(CRLF),
    )
    value = F.concat(head, http, F.when(revisit, "").otherwise(F.col("payload")))
    figures = scratch.spark.read.parquet(scratch.path("headers")).agg(
        F.count(F.lit(1)), F.sum("payload_bytes")
    ).first()
    mean = (figures[1] or 0) / max(1, figures[0])
    (
        records.select(value.alias("value"))
        .write.mode("error")
        .option("lineSep", RECORD_END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", max(1, int(FILE_BYTES / (mean + 500))))
        .text(path)
    )


def parse_archive(data: bytes) -> Iterator[tuple]:
    """Records of an archive's bytes, in order; raises on a damaged one."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "surrogatepass").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record begins at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start, size = end + 4, int(fields["Content-Length"])
        block = data[start : start + size]
        if len(block) < size or data[start + size : start + size + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut short")
        http, _, payload = block.partition(b"\r\n\r\n")
        length = next(
            int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")
        )
        digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        kind = fields["WARC-Type"]
        if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"the payload at byte {at} does not have its digest")
        page_id = fields.get("X-Page-Id")
        yield (
            None if page_id is None else int(page_id),
            fields.get("WARC-Target-URI"),
            kind,
            fields["WARC-Record-ID"],
            fields.get("WARC-Refers-To"),
            digest,
            length,
            payload if kind == "response" else None,
        )
        at = start + size + 4


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of the archives under `path`; without payloads if not asked for."""
    names = [part.split()[0] for part in _RECORD.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                rows = pd.DataFrame(list(parse_archive(data)), columns=names)
                rows["page_id"] = rows["page_id"].astype("Int64")
                if not payloads:
                    rows["payload"] = None
                yield rows

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInPandas(run, _RECORD)


def resolve_revisits(records: DataFrame, scratch: Scratch) -> DataFrame:
    """`records` with `refers_to`: the page of the response that a revisit names."""
    records = scratch.save(records, "records")
    responses = scratch.save(
        records.where("record_type = 'response'")
        .groupBy("record_id")
        .agg(F.max("page_id").alias("refers_to")),
        "responses",
    )
    named = responses.select(F.col("record_id").alias("refers_to_record"), "refers_to")
    return records.join(named, "refers_to_record", "left")


def archive_pages(pages: DataFrame, scratch: Scratch | None = None, path: str | None = None,
                  min_bytes: int = MIN_BYTES) -> DataFrame:
    """Writes the archives of `pages`, reads them back and resolves revisits."""
    spark = pages.sparkSession
    scratch = scratch or Scratch(spark, "warc")
    path = path or scratch.path("archives")
    write_archives(pages, path, scratch, min_bytes)
    return resolve_revisits(read_archives(spark, path, payloads=False).drop("payload"), scratch)
