"""Archives against their format, and what a damaged one gives."""

from __future__ import annotations

import glob
import gzip
import io
import random
import tempfile

import pytest

from riskweave.llm import warc

DATE = "2026-01-02T03:04:05Z"


def pages(spark):
    rows = [(5, "http://a/5", "<p>same</p>"), (3, "http://a/3", "<p>same</p>"), (9, "http://a/9", "<p>same</p>"), (3, "http://a/3", "<p>same</p>"),
            (None, "http://a/-", "<p>same</p>"), (7, None, None), (8, "http://a/8", ""), (1, "bad\r\nX-Field: 1", "é漢😀\r\n\r\nWARC/1.1\r\n\r\n"),
            (None, None, "alone"), (None, "http://b", "alone"), (2, "http://a/2", "x" * 700_000)]
    return spark.createDataFrame([(*r, "digest", 1) for r in rows], "page_id long, url string, html string, digest string, key int").repartition(3)


def expected():
    same, empty = warc.base32_sha1(b"<p>same</p>"), warc.base32_sha1(b"")
    odd = "é漢😀\r\n\r\nWARC/1.1\r\n\r\n".encode()
    return sorted([(5, 11, same, "revisit", 3), (3, 11, same, "response", None), (3, 11, same, "response", None), (9, 11, same, "revisit", 3),
                   (None, 11, same, "revisit", 3), (7, 0, empty, "response", None), (8, 0, empty, "revisit", 7),
                   (1, len(odd), warc.base32_sha1(odd), "response", None), (2, 700_000, warc.base32_sha1(b"x" * 700_000), "response", None),
                   *2 * [(None, 5, warc.base32_sha1(b"alone"), "response", None)]], key=str)


@pytest.mark.parametrize("few_copies", [1, 256])
def test_round_trip(spark, monkeypatch, few_copies):
    monkeypatch.setattr(warc, "FEW_COPIES", few_copies)
    found = warc.warc_round_trip(pages(spark)).collect()
    assert all(r["problem"] is None for r in found)
    assert sorted([tuple(r)[:5] for r in found], key=str) == expected()


def test_payloads_come_back_either_way(spark):
    folder = tempfile.mkdtemp() + "/archives"
    warc.write_warc(pages(spark), folder, least=12, date=DATE)
    for stream in (True, False):
        rows = warc.read_warc(spark, folder, payload=True, stream=stream).filter("record_type = 'response'").collect()
        assert sorted(len(r["payload"]) for r in rows) == sorted([11] * 5 + [0, 0, 5, 5, 700_000, len("é漢😀\r\n\r\nWARC/1.1\r\n\r\n".encode())])
        assert all(r["payload_digest"] == warc.base32_sha1(bytes(r["payload"])) for r in rows)
    # any tool that reads gzip sees whole records, one after another
    text = b"".join(gzip.open(f).read() for f in glob.glob(folder + "/part-*"))
    assert text.count(b"WARC-Type: response\r\n") == 11 and text.endswith(b"\r\n\r\n")
    assert b"WARC-Target-URI: bad X-Field: 1\r\n" in text


def test_empty_table(spark):
    assert warc.warc_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def members(n=6):
    return [warc.page_record(f"urn:page:{i}", f"http://a/{i}", bytes(random.Random(i).randbytes(3000)), DATE, None) for i in range(n)]


def test_members_of_any_length_end_in_the_separator():
    """The writer leaves a zero byte out that Spark adds again; a member whose length has a top byte gets an empty member."""
    large = warc.record([("WARC-Type", "resource")], b"\0" * (1 << 24))
    assert large[-1] != 0 and gzip.decompress(warc.EMPTY_MEMBER) == b""
    rows = list(warc.read_records(io.BytesIO(large + warc.EMPTY_MEMBER + members(1)[0])))
    assert [r["payload_bytes"] for r in rows] == [1 << 24, 3000] and not any(r["problem"] for r in rows)


def test_damage_is_told_and_passed():
    good = members()
    problems = lambda data: [r["problem"] for r in warc.read_records(io.BytesIO(data))]
    assert problems(b"".join(good)) == [None] * 6
    flipped = bytearray(good[2])
    flipped[len(flipped) // 2] ^= 0xFF
    found = problems(b"".join([*good[:2], bytes(flipped), *good[3:]]))
    assert found[:2] == [None, None] and found[-3:] == [None] * 3 and {*found[2:-3]} <= {"damaged", "truncated"} and len(found) > 5
    assert problems(b"".join(good)[:-100])[-1] == "truncated"
    assert problems(b"not gzip" + good[0]) == ["damaged", None]
    plain = gzip.decompress(good[0])
    assert problems(gzip.compress(plain[:-4])) == ["framing"]
    assert problems(gzip.compress(plain + b"more")) == ["framing"]
    assert problems(gzip.compress(plain.replace(b"sha1:", b"sha1:A", 1))) == ["payload digest"]
    assert problems(gzip.compress(plain[:-10] + b"0123456789"[:6] + b"\r\n\r\n")) == ["block digest"]
    assert problems(gzip.compress(b"HTTP/1.1 200 OK\r\n\r\n")) == ["head"]
    assert problems(gzip.compress(plain[:200])) in (["head"], ["truncated"])
    assert problems(b"") == []


def test_pieces_of_any_size(monkeypatch):
    data = b"".join(members())
    want = [{**r} for r in warc.read_records(io.BytesIO(data), True)]
    for size in (1, 7, 1000):
        monkeypatch.setattr(warc, "PIECE", size)
        assert [{**r} for r in warc.read_records(io.BytesIO(data), True)] == want
