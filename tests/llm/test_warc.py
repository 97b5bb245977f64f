"""Exact round trips through archives, reassembly, and odd inputs."""

from __future__ import annotations

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from creditledger.llm import common, warc

SCHEMA = "page_id long, url string, html string"


def brute(rows):
    least = {}
    for page_id, _, page in rows:
        if page_id is not None:
            own = page or ""
            least[own] = min(least.get(own, page_id), page_id)
    out = []
    for page_id, _, page in rows:
        payload = (page or "").encode()
        first = least.get(page or "")
        revisit = first is not None and first != page_id
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page_id, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    return out


def round_trip(spark, rows):
    folder = common.new_folder(spark)
    warc.write(spark.createDataFrame(rows, SCHEMA), folder)
    pages = warc.read_pages(spark, folder)
    pages = pages.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", warc.page_of(F.col("refers_to")).alias("r")
    )
    return folder, [tuple(r) for r in pages.collect()]


def ordered(rows):
    return sorted(rows, key=str)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "SEGMENT_BYTES", 500)
    monkeypatch.setattr(warc, "CHUNK_BYTES", 90)
    rng = random.Random(1)
    bits = ["a", "\r\n", "\r\n\r\n", "\n", "é", "𝔘", "WARC/1.1\r\n", "0\r\n\r\n", "x" * 50, "\r", "Content-Length: 5"]
    rows = [(i, f"http://x/{i}", "".join(rng.choices(bits, k=rng.choice([0, 1, 3, 60, 200])))) for i in range(150)]
    rows += [(200 + i, f"http://y/{i}", rng.choice(rows)[2]) for i in range(60)]
    _, got = round_trip(spark, rows)
    assert ordered(got) == ordered(brute(rows))


def test_segments_are_written_and_joined(spark):
    page = "<p>some text</p>" * 20000
    folder, got = round_trip(spark, [(1, "u", page), (2, "u", page), (3, "u", "small")])
    assert ordered(got) == ordered(brute([(1, "u", page), (2, "u", page), (3, "u", "small")]))
    records = warc.read_records(spark, folder).collect()
    kinds = [r.record_type for r in records]
    assert kinds.count("continuation") == sum((r.segment or 1) > 1 for r in records)
    assert kinds.count("continuation") >= 4 and kinds.count("revisit") == 1
    last = max((r for r in records if r.segment), key=lambda r: r.segment)
    assert last.total == sum(len(r.block) for r in records if r.segment)


def segments(spark, rows):
    full = [
        (f"<{o}:{s}>" if s and s > 1 else f"<{o}>", "response" if s in (None, 1) else "continuation",
         f"<{o}>" if s and s > 1 else None, s, total, 1, None, None, None, bytearray(block))
        for o, s, total, block in rows
    ]
    return spark.createDataFrame(full, warc.RECORD)


def test_reassembly_by_number(spark):
    rows = [("a", 2, None, b"BB"), ("a", 1, None, b"A"), ("b", None, None, b"whole"), ("a", 3, 6, b"CCC")]
    got = {r.record_id: bytes(r.block) for r in warc.reassembled(segments(spark, rows)).collect()}
    assert got == {"<a>": b"ABBCCC", "<b>": b"whole"}
    many = [("m", s, None if s < 40 else 80, b"%02d" % s) for s in range(1, 41)]
    random.Random(0).shuffle(many)
    (row,) = warc.reassembled(segments(spark, many)).collect()
    assert bytes(row.block) == b"".join(b"%02d" % s for s in range(1, 41))


@pytest.mark.parametrize(
    "rows",
    [
        [("a", 1, None, b"A"), ("a", 3, 3, b"CC")],
        [("a", 1, None, b"A"), ("a", 2, 4, b"BB")],
        [("a", 1, None, b"A"), ("a", 2, None, b"BB")],
        [("a", 2, 3, b"BB")],
        [("a", 1, None, b"A"), ("a", 2, 3, b"B"), ("a", 2, 3, b"B")],
    ],
)
def test_missing_segments_raise(spark, rows):
    with pytest.raises(Exception, match="segments missing"):
        warc.reassembled(segments(spark, rows)).collect()


def test_chunks():
    rng = random.Random(3)
    for n in (0, 1, 89, 90, 91, 5000):
        payload = rng.randbytes(n)
        assert warc.unchunked(warc.chunked(payload, 90)) == payload
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"3\r\nabcd\r\n0\r\n\r\n")
    assert warc.http_payload(b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nplain") == b"plain"


def test_given_pages(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html").collect()]
    got = [tuple(r) for r in warc.op10_warc(spark, folder).collect()]
    assert ordered(got) == ordered(brute(rows))


def test_odd_rows(spark):
    rows = [
        (1, None, None),
        (2, "u\r\nX: y", ""),
        (3, "u", "same"),
        (3, "u", "same"),
        (4, "u", "same"),
        (4, "u", "same"),
        (None, "u", "same"),
        (None, "u", "none has an id"),
        (None, "u", "none has an id"),
        (5, "u", "long " * 100000),
        (5, "u", "long " * 100000),
    ]
    _, got = round_trip(spark, rows)
    assert ordered(got) == ordered(brute(rows))
    empty = spark.createDataFrame([], SCHEMA + ", digest string, n long, first long")
    folder = common.new_folder(spark)
    warc.write(empty, folder)
    assert warc.read_pages(spark, folder).count() == 0


def test_large_ids_beside_nulls_are_exact(spark):
    big = 2**60 + 1
    rows = [(big + i, "u", "same") for i in range(3)]
    rows += [(big + 10 + i, "u", f"own {i}") for i in range(3)] + [(None, "u", "no id"), (None, "u", "same")]
    rows += [(big + 20, "u", "long " * 50000), (big + 21, "u", "long " * 50000)]
    folder, got = round_trip(spark, rows)
    assert ordered(got) == ordered(brute(rows))
    pages = {r.record_id: r for r in warc.read_pages(spark, folder).collect()}
    assert all(pages[r.refers_to].record_type == "response" for r in pages.values() if r.refers_to)


def test_a_third_of_all_rows_has_one_payload(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, "u", "<p>same</p>") for i in range(300)] + [(1000 + i, "u", f"<p>{i % 400}</p>") for i in range(600)]
        pages = spark.createDataFrame(rows, SCHEMA)
        got = {r.page_id: r.first and r.first.page_id for r in warc.with_first(pages).collect()}
        assert len(got) == 900 and {got[i] for i in range(300)} == {0}
        assert all(got[1000 + i] == (1000 + i % 400 if i < 200 or i >= 400 else None) for i in range(600))
        _, out = round_trip(spark, rows)
        assert ordered(out) == ordered(brute(rows))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_segments_are_joined_in_one_pass(spark):
    import time

    every = bytes(range(256)) * 256
    number = 1600
    rows = [("r", "response", None if k == 1 else "r", k, number * len(every) if k == number else None) for k in range(1, number + 1)]
    columns = "record_id string, record_type string, origin string, segment int, total bigint"
    segments = spark.createDataFrame(rows, columns).withColumn("block", F.unhex(F.lit(every.hex())))
    started = time.monotonic()
    (row,) = warc.reassembled(segments).select(F.sha2("block", 256).alias("hash")).collect()
    assert time.monotonic() - started < 15
    assert row.hash == hashlib.sha256(every * number).hexdigest()
