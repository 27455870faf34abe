from __future__ import annotations

import hashlib
import io
import random

import pytest

from burstline.llm import warc
from burstline.llm.storage import Scratch

LONG = "<p>" + "é" * 100


def brute(rows):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        refers = None
        if len(payload) >= 100 and page_id is not None and first[html] != page_id:
            refers = first[html]
        kind = "response" if refers is None else "revisit"
        out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), kind, refers))
    return sorted(out, key=str)


ROWS = [
    (5, "http://a", LONG),
    (3, "http://b\r\nX: y z", LONG),
    (4, None, LONG),
    (4, None, LONG),
    (6, "u", "short"),
    (7, "u", "short"),
    (8, "u", None),
    (9, "u", ""),
    (None, "u", LONG),
    (None, "u", "only here" * 20),
    (10, "u", "x" * 99),
    (11, "u", "x" * 99),
    (12, "u", "é" * 50),
    (13, "u", "é" * 50),
    (14, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 20),
    (15, "u", "".join(random.Random(1).choices("abcdef<>/ \x1f", k=700_000))),
]


@pytest.mark.parametrize("split", [warc.SPLIT_BYTES, 97])
def test_round_trip(spark, split):
    frame = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    frame = frame.withColumn("digest", frame.url).repartition(3)
    out = warc.round_trip(frame, split if split > 1000 else 50_000)
    assert sorted(map(tuple, out.drop("url").collect()), key=str) == brute(ROWS)
    urls = {r.page_id: r.url for r in out.collect()}
    assert urls[5] == "http://a" and urls[3] == "http://b%0D%0AX:%20y%20z" and not urls[4]


def test_empty_table(spark):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(frame).count() == 0


def members():
    rng, out = random.Random(3), []
    for k in range(40):
        payload = bytes(rng.randrange(256) for _ in range(rng.randrange(3000)))
        if k % 5 == 0:
            payload = b"\x1f\x8b\x08" * 50 + payload
        digest = hashlib.sha256(payload).hexdigest()
        out.append((k, warc.member(warc.record(k, "u", payload, digest, None)), digest))
    return out


@pytest.mark.parametrize("width", [1, 2, 3, 100, 1000, 4097, 10**6])
def test_ranges_own_each_record_once(width):
    data = b"".join(x[1] for x in members())
    found = []
    for start in range(0, len(data), width):
        window = warc._Window(io.BytesIO(data), len(data))
        found += warc.records_in(window, start, min(len(data), start + width))
    got = [(x["page_id"], x["payload_digest"]) for x in found]
    assert got == [(k, d) for k, _, d in members()]


def test_false_magic_and_foreign_members_are_passed_over():
    good = members()[:2]
    foreign = warc.member(b"not a record")
    data = b"\x1f\x8b\x08junk" + foreign + good[0][1] + b"\x1f\x8b\x08" + foreign + good[1][1]
    window = warc._Window(io.BytesIO(data), len(data))
    found = list(warc.records_in(window, 0, len(data)))
    # What is passed over is named.
    assert [(x["page_id"], x["record_type"]) for x in found] == [
        (None, "damaged"), (None, "foreign"), (0, "response"),
        (None, "damaged"), (None, "foreign"), (1, "response"),
    ]


def test_files_of_lost_attempts_are_not_read(spark):
    frame = spark.createDataFrame(ROWS[:3], "page_id long, url string, html string").coalesce(1)
    scratch = Scratch(spark, "test-warc")
    files = warc.write_archive(frame, scratch)
    name = files.first().file
    folder = scratch.path("archive").removeprefix("file://")
    with open(f"{folder}/{name}", "rb") as a, open(f"{folder}/part-000000-99.warc.gz", "wb") as b:
        b.write(a.read()[:100])
    assert warc.read_archive(files, scratch.path("archive")).count() == 3


def test_members_are_readable_by_gzip():
    import gzip

    data = warc.record(1, "u", b"body", "d", None)
    assert gzip.decompress(warc.member(data)) == data
    assert b"Content-Length: 4\r\n\r\nbody\r\n\r\n" in data


@pytest.mark.parametrize("n", [(1 << 20) + 7, 5 << 20])
def test_long_headers_come_back(n):
    rng = random.Random(n)
    url = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=n))
    digest = hashlib.sha256(b"payload").hexdigest()
    data = b"".join(warc.member(warc.record(k, u, b"payload", digest, None)) for k, u in enumerate(["a", url, "b"]))
    found = list(warc.records_in(warc._Window(io.BytesIO(data), len(data)), 0, len(data)))
    assert [(x["page_id"], x["url"], x["payload_digest"]) for x in found] == [
        (0, "a", digest), (1, url, digest), (2, "b", digest)
    ]


def by_hand(version, kind, block, *more):
    """A record as other writers make it."""
    lines = [f"WARC/{version}", f"WARC-Type: {kind}", *more, f"Content-Length: {len(block)}"]
    return warc.member("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


UUID = "<urn:uuid:4885803b-eebd-4b27-a090-144450c11594>"
HTTP = "Content-Type: application/http;msgtype=response"


def archive_of_others():
    page = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n<html>body</html>"
    return [
        by_hand("1.0", "warcinfo", b"software: other\r\n", f"WARC-Record-ID: {UUID}"),
        by_hand("1.0", "request", b"GET / HTTP/1.1\r\n\r\n", "Content-Type: application/http; msgtype=request"),
        by_hand("1.0", "response", page, f"WARC-Record-ID: {UUID}", HTTP, "WARC-Target-URI: http://a"),
        by_hand("1.1", "response", page, "warc-record-id: <urn:page:x7>", HTTP.upper(), "X-Folded: a\r\n  b"),
        by_hand("1.1", "response", b"no header at all", HTTP),
        by_hand("1.1", "resource", b"\r\n\r\nplain", "Content-Type: text/plain"),
        by_hand("1.0", "metadata", b"", "WARC-Record-ID: <urn:page:>"),
        by_hand("1.1", "revisit", b"HTTP/1.1 304\r\n\r\n", HTTP, "WARC-Payload-Digest: sha1:ABC", f"WARC-Refers-To: {UUID}"),
        by_hand("1.1", "revisit", b"", "WARC-Refers-To-Target-URI: http://a"),
        by_hand("1.1", "revisit", b"HTTP/1.1 200\r\nContent-Length: 12x\r\n\r\n", HTTP),
        by_hand("1.2", "conversion", b"text"),
    ]


def test_archives_of_other_writers():
    data = b"".join(archive_of_others())
    found = list(warc.records_in(warc._Window(io.BytesIO(data), len(data)), 0, len(data)))
    sha = lambda x: hashlib.sha256(x).hexdigest()
    body = b"<html>body</html>"
    got = [(x["record_type"], x["payload_bytes"], x["payload_digest"]) for x in found]
    assert got == [
        ("warcinfo", 17, sha(b"software: other\r\n")),
        ("request", 18, sha(b"GET / HTTP/1.1\r\n\r\n")),
        ("response", len(body), sha(body)),
        ("response", len(body), sha(body)),
        ("response", 16, sha(b"no header at all")),
        ("resource", 9, sha(b"\r\n\r\nplain")),
        ("metadata", 0, sha(b"")),
        ("revisit", None, "sha1:ABC"),
        ("revisit", None, None),
        ("revisit", None, None),
        ("conversion", 4, sha(b"text")),
    ]
    assert {x["page_id"] for x in found} == {None} == {x["refers_to"] for x in found}
    assert found[2]["record_id"] == UUID == found[7]["refers_to_id"] and found[2]["url"] == "http://a"


def test_members_that_are_no_sound_records():
    good = warc.member(warc.record(1, "u", b"body", "d", None))
    short = warc.member(b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 50\r\n\r\ntoo little")
    odd = warc.member(b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: many\r\n\r\n")
    cut = good[: len(good) // 2]
    for bad, kind in [(short, "damaged"), (odd, "damaged"), (cut, "damaged"), (warc.member(b""), "foreign")]:
        data = good + bad + good
        found = list(warc.records_in(warc._Window(io.BytesIO(data), len(data)), 0, len(data)))
        assert [x["record_type"] for x in found] == ["response", kind, "response"]


def test_other_archives_through_spark(spark, tmp_path):
    data = archive_of_others() * 20
    (tmp_path / "a.warc.gz").write_bytes(b"".join(data))
    files = spark.createDataFrame([("a.warc.gz", len(b"".join(data)))], "file string, bytes long")
    for split in (100, 5000, 1 << 20):
        read = warc.read_archive(files, f"file://{tmp_path}", split)
        counts = {r.record_type: r["count"] for r in read.groupBy("record_type").count().collect()}
        assert counts == {
            "warcinfo": 20, "request": 20, "response": 60, "resource": 20, "metadata": 20,
            "revisit": 60, "conversion": 20,
        }
