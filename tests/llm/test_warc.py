"""The archive against pages read one by one, and byte for byte."""

from __future__ import annotations

import base64
import hashlib
import random

import pytest

from pyspark.sql import functions as F

from tidecast.llm import warc
from tidecast.llm.warc import Settings

PAGES = "page_id long, url string, html string"


def rows():
    rng = random.Random(5)
    out = [
        (7, "http://a/1", "same"), (3, "http://a/2", "same"), (9, "http://a/3", "same"),
        (3, "http://a/2", "same"),  # a repeated row
        (4, None, None), (5, "http://b/\r\nWARC-Type: x", ""), (6, "http://ä/é", "WARC/1.1\r\n\r\n\r\n\r\nbody"),
        (None, "http://n", "no id"), (None, "http://n", "no id"), (8, "http://n", "no id"),
        (None, "http://m", "alone"), (10, "http://c", "\x00\n퟿\U0001f600 é\r\n\r\n"),
        (11, "http://long/" + "u" * 70_000, "<p>" + "long é " * 300_000),
    ]
    out += [(100 + i, f"http://s/{i}", "hot") for i in range(400)]
    out += [(1000 + i, f"http://t/{i}", f"page {rng.randrange(30)}") for i in range(100)]
    return out


def slow(pages, smallest: int = 0):
    groups = {}
    for i, (page_id, _, html) in enumerate(pages):
        groups.setdefault(html or "", []).append((page_id is None, page_id or 0, i))
    out = []
    for i, (page_id, _, html) in enumerate(pages):
        data = (html or "").encode()
        first = min(groups[html or ""])
        revisit = first[2] != i and len(data) >= smallest
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        target = None if first[0] else first[1]
        out.append((page_id, len(data), digest, *(("revisit", target) if revisit else ("response", None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("smallest", [0, 4, 10**9])
def test_pages_come_back(spark, smallest):
    pages, settings = rows(), Settings(min_bytes=smallest, salts=4)
    df = spark.createDataFrame(pages, PAGES).repartition(6)
    got = warc.archived_pages(warc.write_archive(df, settings=settings), settings)
    assert sorted(map(tuple, got.collect()), key=str) == slow(pages, smallest)


def test_records_are_whole_and_payloads_stored_once(spark):
    pages = rows()
    archive = warc.write_archive(spark.createDataFrame(pages, PAGES).repartition(3))
    stored = [bytes(r["payload"]) for r in archive.payloads.collect()]
    assert sorted(stored) == sorted({(p[2] or "").encode() for p in pages})
    assert sum(r.count(b"WARC-Type: response") for r, in archive.responses.select("header").collect()) == len(stored)
    read = warc.read_records(warc.records(archive)).collect()
    assert len(read) == len(pages)
    payload = {r["record_id"]: bytes(r["payload"]) for r in read if r["record_type"] == "response" and r["record_id"] != "<urn:page:>"}
    for r in read:
        if r["record_id"] == "<urn:page:6>":
            assert r["target"] == "http://ä/é" and bytes(r["payload"]) == b"WARC/1.1\r\n\r\n\r\n\r\nbody"
        if r["record_id"] == "<urn:page:5>":
            # Equal to page 4, and its address breaks no header line.
            assert (r["record_type"], r["refers_to"]) == ("revisit", "<urn:page:4>")
            assert r["target"] == "http://b/%0D%0AWARC-Type: x"
        if r["refers_to"] in payload:
            digest = base64.b32encode(hashlib.sha1(payload[r["refers_to"]]).digest()).decode()
            assert digest == r["payload_digest"]


def test_headers_are_kept_byte_by_byte(spark):
    page = [(1, "http://a", "é")]
    archive = warc.write_archive(spark.createDataFrame(page, PAGES))
    record = bytes(warc.records(archive).first()["record"])
    digest = base64.b32encode(hashlib.sha1("é".encode()).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: 2\r\n\r\n"
    want = (
        "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Target-URI: http://a\r\n"
        f"WARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Payload-Digest: sha1:{digest}\r\n"
        f"Content-Type: application/http;msgtype=response\r\nContent-Length: {len(http) + 2}\r\n\r\n"
    ).encode() + http + "é".encode() + b"\r\n\r\n"
    assert record == want
    assert bytes(archive.responses.first()["header"]) == want[: -len("é".encode()) - 4]


def test_damage_is_noticed(spark):
    archive = warc.write_archive(spark.createDataFrame(rows()[:3], PAGES))
    other = archive.payloads.withColumn("payload", F.lit("forged").cast("binary"))
    forged = warc.Archive(archive.path, other, archive.responses, archive.revisits)
    with pytest.raises(Exception, match="no whole record|differ"):
        warc.read_records(warc.records(forged)).collect()
    lost = warc.Archive(archive.path, archive.payloads.where("false"), archive.responses, archive.revisits)
    with pytest.raises(Exception, match="no payload of digest"):
        warc.records(lost).collect()
    with pytest.raises(ValueError, match="differ"):
        warc.parse_record(bytes(warc.records(archive).first()["record"]).replace(b"same", b"sane"))


def test_payloads_cross_one_shuffle_and_no_join(spark):
    archive = warc.write_archive(spark.createDataFrame(rows(), PAGES))
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, -1)
    try:
        plan = warc.records(archive)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_empty_and_clashing(spark):
    none = spark.createDataFrame([], PAGES)
    assert warc.archived_pages(warc.write_archive(none)).count() == 0
    df = spark.createDataFrame(rows(), PAGES)
    df = df.withColumns({c: F.lit("x") for c in ("key", "row", "payload", "sha1", "_salt", "header", "first", "bytes")})
    got = warc.archived_pages(warc.write_archive(df))
    assert sorted(map(tuple, got.collect()), key=str) == slow(rows())
