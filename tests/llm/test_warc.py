from __future__ import annotations

import gzip
import hashlib
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tastes.llm.common import Scratch
from tastes.llm.warc import archive_pages, parse_archive, read_archives, write_archives

PAGES = "page_id long, url string, html string"
BIG = "<p>" + "é" * 600 + "</p>"


def expected(rows):
    most = {}
    for i, _, html in rows:
        if html and len(html.encode()) >= 1000 and i is not None:
            most[html] = max(i, most.get(html, i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        n = sum(1 for r in rows if r[2] == html)
        revisit = len(data) >= 1000 and n > 1 and html in most and most[html] != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    most[html] if revisit else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(
        [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()], key=str
    )


def test_round_trip(spark):
    rng = random.Random(0)
    tricky = ["\r\n\r\n", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "\x00", " \r\n", BIG, BIG + "\r\n\r\n", ""]
    rows = [(i, f"http://h{i % 3}.example/{i}", rng.choice([*tricky, "x" * 999, "x" * 1000, f"<b>{i}</b>"])) for i in range(200)]
    rows += [(500, None, None), (None, "http://a b/\r\nX: y", BIG), (None, None, "small"), (199, "http://again", BIG),
             (900, "u", "y" * 2_000_000), (901, "v", "y" * 2_000_000)]
    pages = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit(1) for c in ("digest", "payload", "value", "n")})
    assert rows_of(archive_pages(pages.repartition(4))) == expected(rows)


def test_largest_id_twice_gives_two_responses(spark):
    rows = [(5, "a", BIG), (5, "b", BIG), (3, "c", BIG)]
    found = rows_of(archive_pages(spark.createDataFrame(rows, PAGES)))
    assert [(r[0], r[3], r[4]) for r in found] == [(3, "revisit", 5), (5, "response", None), (5, "response", None)]


def test_archives_are_plain_warc_files_with_payloads(spark):
    scratch = Scratch(spark, "warc-test")
    rows = [(i, "http://h/", BIG + str(i % 4)) for i in range(12)]
    write_archives(spark.createDataFrame(rows, PAGES).repartition(3), scratch.path("a"), scratch)
    found = read_archives(spark, scratch.path("a")).collect()
    assert {bytes(r.payload).decode() for r in found if r.record_type == "response"} == {r[2] for r in rows}
    assert sum(r.record_type == "revisit" and r.payload is None for r in found) == 8
    files = list(Path(scratch.path("a").removeprefix("file:")).glob("part-*.gz"))
    data = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert data.count(b"WARC-Payload-Digest: sha1:") == 12 and data.endswith(b"\r\n\r\n")


def test_damage_is_noticed():
    payload = b"text"
    good = (
        b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Payload-Digest: sha1:"
        + b"BKI2M5GYHFMDYPZRFA5Y7VEDBV4XF4PI"
        + b"\r\nContent-Length: 26\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\n"
    )
    with pytest.raises(ValueError, match="cut short|does not have"):
        list(parse_archive(good + payload))


def test_empty_table(spark):
    assert archive_pages(spark.createDataFrame([], PAGES)).count() == 0
