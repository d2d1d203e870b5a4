import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tallyroute.llm import warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, refers string, id int").select("id", "page_id", "html", "url", "digest", "refers")


def test_chunk_framing_round_trip():
    for payload in (b"", b"x", b"0\r\n\r\n" * 9, bytes(range(256)) * 100):
        assert warc.unchunked(warc.chunked(payload)) == payload
    assert warc.unchunked(b"3;name=value\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    for broken in (b"", b"3\r\nab", b"3\r\nabcd\r\n0\r\n\r\n", b"zz\r\n", b"-1\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(broken)


def test_pages_come_back(spark):
    long = "é€ line\r\n\r\nWARC/1.1\r\n" * 500
    rows = [(3, "http://a/", long), (1, "http://b/\r\nX: y", long), (7, None, long), (4, "u", None), (5, "u", ""), (6, "u", "s" * 99), (8, "u", "s" * 99)]
    rows += [(9, "u", "t" * 100), (9, "u", "t" * 100), (10, "u", "t" * 100), (None, "u", "t" * 100), (None, "u", long[:-1]), (None, "u", long[:-1])]
    found = warc.archived(pages(spark, [(*r, "d", "r", 1) for r in rows]), segment_bytes=700).collect()
    got = sorted((r.record_id.split(":")[2], r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.fault) for r in found)

    def want(key, payload, refers=None):
        data = (payload or "").encode()
        kind = "response" if refers is None else "revisit"
        return ("" if key is None else str(key), len(data), hashlib.sha256(data).hexdigest(), kind, refers and f"urn:page:{refers}", None)

    refers = [1, None, 1, None, None, None, None, None, None, 9, 9, None, None]
    assert sorted(got, key=str) == sorted((want(k, p, r) for (k, _, p), r in zip(rows, refers, strict=True)), key=str)


def test_no_pages(spark):
    assert warc.archived(pages(spark, [])).collect() == []


def records(spark, parts):
    kind = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, segment int, origin string, total_length long, block binary, fault string"
    return spark.createDataFrame(parts, kind)


@pytest.mark.parametrize(
    "segments, fault",
    [
        ([(2, None, b"c"), (1, None, b"ab"), (3, 4, b"d")], None),
        ([(1, None, b"ab"), (3, 4, b"d")], "segments are missing or repeated"),
        ([(1, None, b"ab"), (1, None, b"ab"), (2, 4, b"cd")], "segments are missing or repeated"),
        ([(1, None, b"ab"), (2, None, b"cd")], "no total length"),
        ([(1, None, b"ab"), (2, 5, b"cd")], "total length is wrong"),
        ([(2, 4, b"cd")], "segments are missing or repeated"),
    ],
)
def test_reassembly(spark, segments, fault):
    rows = [
        ("r" if n == 1 else f"r:{n}", "response" if n == 1 else "continuation", None, None, None, n, None if n == 1 else "r", total, bytearray(block), None)
        for n, total, block in segments
    ]
    (found,) = warc.reassembled(records(spark, rows)).collect()
    assert found.fault == fault
    if fault is None:
        assert bytes(found.block) == b"abcd" and found.record_id == "r" and found.record_type == "response"


def test_archives_of_others(spark, tmp_path):
    """Plain files, one gzip member a record, and broken ones."""
    first = warc.record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:a>")], b"x: y") + b"\r\n"
    second = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:b>")], b"HTTP/1.1 200 OK\r\n\r\nbody") + b"\r\n"
    (tmp_path / "plain.warc").write_bytes(first + second)
    (tmp_path / "members.warc.gz").write_bytes(gzip.compress(first) + gzip.compress(second))
    (tmp_path / "cut.warc").write_bytes(second[:-9])
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(second)[:-12])
    (tmp_path / "other.warc").write_bytes(b"hello\r\n\r\n")
    found = warc.payloads(warc.reassembled(warc.read_records(spark, str(tmp_path)))).select("record_id", "payload", F.col("fault").isNotNull().alias("bad")).collect()
    assert sorted((r.record_id, bytes(r.payload or b""), r.bad) for r in found if not r.bad) == [("urn:a", b"", False)] * 2 + [("urn:b", b"body", False)] * 2
    assert sum(r.bad for r in found) == 3


def test_missing_response_is_reported(spark):
    decoded = spark.createDataFrame(
        [("urn:page:2:0", "revisit", None, "urn:page:1", None, None, "d", None)],
        "record_id string, record_type string, target_uri string, refers_to string, payload binary, payload_bytes long, payload_digest string, fault string",
    )
    assert [r.fault for r in warc.catalogue(decoded).collect()] == ["no such response"]
