"""WARC archives in Zstandard: one frame per record, after a skippable frame that holds the dictionary.

The writer makes response and revisit records; the reader streams an archive, takes the dictionary from the leading
skippable frame, decodes frame by frame and checks each record's headers, lengths and digests.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import batch_of, pieces, project, scratch_path, written

# Fixed values of the formats.
SKIPPABLE, FRAME, DICTIONARY = 0x184D2A5D, 0xFD2FB528, 0xEC30A437
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

LEAST_REVISIT = 1000
ROLL = 64 << 20  # an archive is closed when it has so many bytes


class ArchiveError(ValueError):
    """An archive that breaks the format."""


def record(kind: str, record_id: str, date: str, block: bytes, fields: dict[str, str]) -> bytes:
    """A whole record. Control characters in field values are percent-encoded."""
    head = {"WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": date, **fields, "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {re.sub(r'[\x00-\x1f\x7f]', lambda m: f'%{ord(m[0]):02X}', v)}\r\n" for k, v in head.items())
    return f"{VERSION}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record; raises ArchiveError where it breaks the format."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or lines[0] != VERSION:
        raise ArchiveError(f"not a {VERSION} record: {raw[:40]!r}")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ArchiveError(f"bad header line {line!r}")
        fields[name] = value.strip()
    if missing := [n for n in NEEDED if n not in fields]:
        raise ArchiveError(f"no {', '.join(missing)}")
    if not fields["Content-Length"].isdigit():
        raise ArchiveError(f"bad Content-Length {fields['Content-Length']!r}")
    length = int(fields["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ArchiveError(f"Content-Length {length}, but {len(rest) - 4} bytes follow")
    return fields, rest[:length]


def http_response(payload: bytes) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload


def payload_of(block: bytes) -> bytes:
    """The HTTP body, whose length its own header must state."""
    head, gap, body = block.partition(b"\r\n\r\n")
    stated = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", head.replace(b"\r\n", b"\n"))
    if not gap or not head.startswith(b"HTTP/") or not stated or int(stated[1]) != len(body):
        raise ArchiveError("the HTTP message breaks its header")
    return body


def leading_frame(dictionary: bytes) -> bytes:
    """The skippable frame with the dictionary, itself compressed."""
    packed = zstandard.ZstdCompressor().compress(dictionary)
    return struct.pack("<II", SKIPPABLE, len(packed)) + packed


def frames(stream: BinaryIO, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The decoded content of each frame; holds one frame and one chunk at a time."""
    data = stream.read(8)
    loaded = None
    if len(data) == 8 and struct.unpack("<I", data[:4])[0] == SKIPPABLE:
        size = struct.unpack("<I", data[4:])[0]
        body = stream.read(size)
        if len(body) < size:
            raise ArchiveError("the dictionary's frame is cut off")
        if body[:4] == struct.pack("<I", FRAME):
            body = zstandard.ZstdDecompressor().decompress(body, max_output_size=64 << 20)
        if body[:4] != struct.pack("<I", DICTIONARY):
            raise ArchiveError("the leading frame holds no dictionary")
        loaded, data = zstandard.ZstdCompressionDict(body), b""
    decompressor = zstandard.ZstdDecompressor(dict_data=loaded)
    while data or (data := stream.read(chunk)):
        one, parts = decompressor.decompressobj(), []
        while True:
            try:
                parts.append(one.decompress(data))
            except zstandard.ZstdError as e:
                raise ArchiveError(f"bad frame: {e}") from e
            if one.eof:
                data = one.unused_data
                break
            if not (data := stream.read(chunk)):
                raise ArchiveError("the last frame is cut off")
        yield b"".join(parts)


def train(samples: list[bytes], size: int = 64 << 10) -> bytes:
    """A dictionary, or no bytes where the samples are too few to train one."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def planned(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, refers_to): of equal payloads of LEAST_REVISIT bytes or more, all but those with the largest
    page_id refer to it. Null payloads are empty; rows without page_id are responses unless another row has the payload.
    Repeated rows with the largest page_id are all responses.

    Digests are counted before the payloads move, and only those of several rows are joined.
    """
    rows = project(pages, page_id="long", url="string", html="string").withColumn("html", F.coalesce("html", F.lit("")))
    keyed = rows.withColumn("digest", F.when(F.octet_length("html") >= LEAST_REVISIT, F.sha1("html")))
    groups = keyed.where("digest is not null").groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").select("digest", "last")
    refers = F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return keyed.join(groups, "digest", "left").select("page_id", "url", "html", refers.alias("refers_to"))


def write(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", samples: int = 400, longest: int = 64 << 10) -> DataFrame:
    """Writes a record per row of planned() rows into archives in `folder`; returns (path, records) of the archives.

    The dictionary is trained on at most `samples` pages of at most `longest` bytes, those of the lowest hash. A task
    that is run again writes files of another name; only those that the returned table lists count.
    """
    small = pages.where((F.col("html") != "") & (F.octet_length("html") <= longest)).select(F.xxhash64("html").alias("hash"), "html")
    lowest = small.select("hash").distinct().orderBy("hash").limit(samples).agg(F.max("hash")).first()[0]
    chosen = small.where(F.col("hash") <= F.lit(lowest)).groupBy("hash").agg(F.first("html").alias("html"))  # a row per hash
    dictionary = train([r.html.encode() for r in chosen.orderBy("hash").collect()])
    schema = pa.schema([("path", pa.string()), ("records", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        made: list[tuple[str, int]] = []
        out, count, size = None, 0, 0
        pack = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        for batch in pieces(batches, "html"):
            for page_id, url, html, refers_to in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if out is None:
                    name = f"pages-{task.partitionId():05d}-{task.taskAttemptId()}-{len(made):04d}.warc.zst"
                    out, count, size = store.open_output_stream(f"{base}/{name}"), 0, 0
                    if dictionary:
                        size += out.write(leading_frame(dictionary))
                    made.append((f"{folder}/{name}", 0))
                payload = html.encode()
                fields = {"Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": "sha1:" + hashlib.sha1(payload).hexdigest(), "WARC-Payload-Length": str(len(payload))}
                if url is not None:
                    fields["WARC-Target-URI"] = url
                block = http_response(payload)
                if refers_to is not None:
                    fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
                    block = block[: len(block) - len(payload)]
                fields["WARC-Block-Digest"] = "sha1:" + hashlib.sha1(block).hexdigest()
                own = "none" if page_id is None else page_id
                size += out.write(pack.compress(record("revisit" if refers_to is not None else "response", f"<urn:page:{own}>", date, block, fields)))
                count += 1
                made[-1] = (made[-1][0], count)
                if size >= ROLL:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        yield batch_of(schema, [[m[0] for m in made], [m[1] for m in made]])

    return written(pages.select("page_id", "url", "html", "refers_to").mapInArrow(run, "path string, records long"), "archives")


def checked(raw: bytes) -> dict:
    """A record of write() as a row; raises ArchiveError where its digests or lengths are wrong."""
    fields, block = parsed(raw)
    if fields.get("WARC-Block-Digest") != "sha1:" + hashlib.sha1(block).hexdigest():
        raise ArchiveError("the block breaks its digest")
    kind, length = fields["WARC-Type"], int(fields.get("WARC-Payload-Length", -1))
    digest = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    ident = lambda name: None if (m := re.fullmatch(r"<urn:page:(-?\d+|none)>", fields.get(name, "")))[1] == "none" else int(m[1])
    if kind == "response":
        body = payload_of(block)
        if len(body) != length or hashlib.sha1(body).hexdigest() != digest:
            raise ArchiveError("the payload breaks its digest or length")
    elif kind != "revisit" or fields.get("WARC-Profile") != PROFILE or "WARC-Refers-To" not in fields:
        raise ArchiveError(f"no record of this writer: {kind}")
    else:
        body = None
    return {"page_id": ident("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": length, "payload_digest": digest, "record_type": kind, "refers_to": ident("WARC-Refers-To") if kind == "revisit" else None, "payload": body}


def read(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """A row per record of the archives that column path names, and with `payloads` the payload of responses too.

    Each archive is streamed by one task; archives hold ROLL bytes or little more.
    """
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payloads
    kinds = {"page_id": "long", "url": "string", "payload_bytes": "long", "payload_digest": "string", "record_type": "string", "refers_to": "long", "payload": "binary"}
    arrow = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(n, arrow[kinds[n]]) for n in names])

    def rows(paths: Iterable[str]) -> Iterator[dict]:
        from pyarrow import fs

        for path in paths:
            store, at = fs.FileSystem.from_uri(path)
            with store.open_input_stream(at) as stream:
                for raw in frames(stream):
                    yield checked(raw)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in rows(p for b in batches for p in b.column(0).to_pylist()):
            held.append(row)
            size += 200 + (len(row["payload"] or b"") if payloads else 0)
            if size >= 4 << 20:
                yield batch_of(schema, [[r[n] for r in held] for n in names])
                held, size = [], 0
        yield batch_of(schema, [[r[n] for r in held] for n in names])

    paths = archives.select("path")
    return paths.repartition(max(1, min(paths.count(), 10_000)), "path").mapInArrow(run, ", ".join(f"{n} {kinds[n]}" for n in names))


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes all pages to archives in the shared folder and reads them back."""
    return read(write(planned(pages), scratch_path(pages.sparkSession, "warc"))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
