import hashlib
import io
import random
import struct

import pytest
import zstandard

from heddle.llm import warc
from heddle.llm._common import scratch_path

from .cases import prose

SCHEMA = "page_id long, url string, html string, URL string, payload_bytes int"


def brute(rows):
    out = []
    for page, _, html, *_ in rows:
        html = html or ""
        same = [p for p, _, h, *_ in rows if (h or "") == html and p is not None]
        refers = max(same) if len(html.encode()) >= 1000 and same and page != max(same) else None
        out.append((page, len(html.encode()), hashlib.sha1(html.encode()).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def pages(rng):
    big, edge = prose(rng, 400), "é" * 500
    rows = [(i, f"http://x/{i}\r\n", h, None, 1) for i, h in enumerate([big, "small", big, None, "", edge, edge, edge[:-1], edge[:-1], big, "small", prose(rng, 30_000)])]
    return rows + [(None, None, big, None, 2), rows[9], (None, "u", "only here " * 200, None, 3)] + [(100 + i, "http://y/", prose(rng, 60), None, 0) for i in range(30)]


def test_round_trip(spark):
    rows = pages(random.Random(2))
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, warc.round_trip(docs).collect()), key=repr) == brute(rows)
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_payloads_come_back(spark):
    rows = pages(random.Random(3))
    archives = warc.write(warc.planned(spark.createDataFrame(rows, SCHEMA)), scratch_path(spark, "warc-test"))
    got = warc.read(archives, payloads=True).collect()
    kinds = {(b[0], b[2]): b[3] for b in brute(rows)}
    expected = [(html or "").encode() for page, _, html, *_ in rows if kinds[page, hashlib.sha1((html or "").encode()).hexdigest()] == "response"]
    assert sorted(bytes(r.payload) for r in got if r.record_type == "response") == sorted(expected)
    assert sum(r.records for r in archives.collect()) == len(rows)


def frame_of(record, dictionary=b""):
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None).compress(record)


def sample():
    return warc.record("response", "<urn:page:1>", "2024-01-01T00:00:00Z", warc.http_response(b"hello"), {"WARC-Payload-Length": "5", "WARC-Payload-Digest": "sha1:" + hashlib.sha1(b"hello").hexdigest(), "WARC-Block-Digest": "sha1:" + hashlib.sha1(warc.http_response(b"hello")).hexdigest()})


def test_frames_with_and_without_dictionary():
    rng = random.Random(1)
    dictionary = warc.train([prose(rng, 200).encode() for _ in range(60)], 4096)
    assert dictionary
    record = sample()
    raw = struct.pack("<II", warc.SKIPPABLE, len(dictionary)) + dictionary
    for head, d in ((b"", b""), (warc.leading_frame(dictionary), dictionary), (raw, dictionary)):
        for chunk in (7, 1 << 20):
            assert list(warc.frames(io.BytesIO(head + frame_of(record, d) * 3), chunk)) == [record] * 3
    assert list(warc.frames(io.BytesIO(b""))) == []
    assert warc.checked(record)["payload"] == b"hello"


@pytest.mark.parametrize(
    "broken",
    [
        lambda r: r.replace(b"WARC/1.1", b"WARC/0.9"), lambda r: r[:-1], lambda r: r + b"x", lambda r: r.replace(b"WARC-Date", b"WARC-Dote"), lambda r: r.replace(b"hello", b"jello"),
        lambda r: r.replace(b"Content-Length: 5", b"Content-Length: 6"), lambda r: r.replace(b"WARC-Type: response", b"WARC-Type response"), lambda r: r.replace(b"WARC-Payload-Length: 5", b"WARC-Payload-Length: 4"),
    ],
)
def test_broken_records_raise(broken):
    with pytest.raises(warc.ArchiveError):
        warc.checked(broken(sample()))


@pytest.mark.parametrize("data", [struct.pack("<II", warc.SKIPPABLE, 50) + b"abc", struct.pack("<II", warc.SKIPPABLE, 8) + b"12345678", b"not a frame at all", None])
def test_broken_archives_raise(data):
    with pytest.raises(warc.ArchiveError):
        list(warc.frames(io.BytesIO(data if data is not None else frame_of(sample())[:-3])))
