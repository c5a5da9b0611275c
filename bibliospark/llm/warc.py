"""WARC archives with per-record Zstandard frames and a shared dictionary (operator 8).

An archive starts with a skippable frame that holds the dictionary; each
record after it is one frame of its own.  Writing and reading are row-local:
every task writes its own archives and returns a manifest row per archive;
the manifest is a table, so files of failed attempts are never read.  Readers
stream an archive frame by frame and check frames, headers, lengths and
digests.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, looked_up, saved, scratch

# Fixed values of the two formats.
SKIPPABLE_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_REVISIT = 1000  # payload bytes from which equal payloads are stored once
DICTIONARY, SAMPLE = 64 << 10, 4 << 20  # bytes of a dictionary, and of payloads it is made from, at most
ROLL = 64 << 20  # compressed bytes after which a task begins another archive
READ = 1 << 20

REFERENCE = "urn:page:"
SCHEMA = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "url string, payload binary"
)


class WarcError(ValueError):
    """An archive that breaks the format; says where."""


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def record_bytes(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record: a whole HTTP response, or the HTTP header alone of a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if kind == "response" else b"")
    header = [
        VERSION.decode(),
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{REFERENCE}{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        header.append("WARC-Target-URI: " + quote(url, safe="!\"#$&'()*+,/:;<=>?@[\\]^`{|}~%"))
    if refers_to is not None:
        header += [f"WARC-Refers-To: <{REFERENCE}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    header += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(header).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"malformed header line {line[:80]!r}")
        out[name.lower()] = value.strip()
    return out


def _page(uri: str, where: str) -> int | None:
    if not (uri.startswith(f"<{REFERENCE}") and uri.endswith(">")):
        raise WarcError(f"{where}: not a record reference: {uri[:80]!r}")
    number = uri[len(REFERENCE) + 1 : -1]
    return int(number) if number else None


def parse_record(raw: bytes) -> dict:
    """The fields of one record; raises WarcError unless version, headers, lengths and digest hold."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise WarcError(f"not a {VERSION.decode()} record")
    h = _headers(lines[1:])
    missing = {"warc-type", "warc-record-id", "warc-date", "warc-payload-digest", "content-length"} - h.keys()
    if missing:
        raise WarcError(f"headers missing: {sorted(missing)}")
    try:
        datetime.fromisoformat(h["warc-date"])
    except ValueError as e:
        raise WarcError(f"bad WARC-Date {h['warc-date']!r}") from e
    if not h["content-length"].isdigit() or int(h["content-length"]) + 4 != len(rest) or not rest.endswith(b"\r\n\r\n"):
        raise WarcError(f"Content-Length {h['content-length']} does not fit a block of {len(rest) - 4} bytes")
    http, gap, payload = rest[:-4].partition(b"\r\n\r\n")
    http_lines = http.split(b"\r\n")
    if not gap or not http_lines[0].startswith(b"HTTP/"):
        raise WarcError("no HTTP header in the block")
    length = int(_headers(http_lines[1:])["content-length"])
    kind, digest = h["warc-type"], h["warc-payload-digest"].removeprefix("sha1:")
    refers_to = None
    if kind == "response":
        if length != len(payload):
            raise WarcError(f"HTTP Content-Length {length}, payload of {len(payload)} bytes")
        if hashlib.sha1(payload).hexdigest() != digest:
            raise WarcError("payload digest differs")
    elif kind == "revisit":
        if payload or "warc-refers-to" not in h or h.get("warc-profile") != REVISIT_PROFILE:
            raise WarcError("a revisit needs no payload, WARC-Refers-To and its profile")
        refers_to = _page(h["warc-refers-to"], "WARC-Refers-To")
    else:
        raise WarcError(f"unknown record type {kind!r}")
    return {
        "page_id": _page(h["warc-record-id"], "WARC-Record-ID"),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": refers_to,
        "url": h.get("warc-target-uri"),
        "payload": payload if kind == "response" else None,
    }


def make_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; where there is too little to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY]


class ArchiveWriter:
    """One archive: the dictionary's skippable frame, then a frame for each record."""

    def __init__(self, sink: BinaryIO, dictionary: bytes, level: int = 3) -> None:
        self.sink, self.size, self.records = sink, 0, 0
        self._put(struct.pack("<II", SKIPPABLE_MAGIC, len(dictionary)) + dictionary)
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=data, write_content_size=True, write_checksum=True)

    def _put(self, raw: bytes) -> None:
        self.sink.write(raw)
        self.size += len(raw)

    def add(self, record: bytes) -> None:
        self._put(self.compressor.compress(record))
        self.records += 1


def read_frames(source: BinaryIO) -> Iterator[bytes]:
    """Decoded frames of an archive, one at a time; memory holds one frame and one read."""

    def exactly(n: int) -> bytes:
        got = source.read(n)
        if len(got) < n:
            raise WarcError("the archive ends inside its dictionary")
        return got

    magic, size = struct.unpack("<II", exactly(8))
    if magic != SKIPPABLE_MAGIC:
        raise WarcError("no leading skippable frame")
    dictionary = exactly(size)
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    decompressor = zstandard.ZstdDecompressor(dict_data=data)
    left = b""
    while left or (left := source.read(READ)):
        while len(left) < 4 and (more := source.read(READ)):
            left += more
        if left[:4] != FRAME_MAGIC:
            raise WarcError("no frame where a record should begin")
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if not left and not (left := source.read(READ)):
                raise WarcError("the archive ends inside a frame")
            try:
                parts.append(frame.decompress(left))
            except zstandard.ZstdError as e:
                raise WarcError(f"broken frame: {e}") from e
            left = b""
        left = frame.unused_data
        yield b"".join(parts)


def record_types(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``pages`` (page_id, url, payload) with digest, record_type and refers_to.

    Counting uses (page_id, digest) alone, and a digest is looked up under a
    salt, so a page copied a million times is no hot key; payloads are joined
    by their own page_id, and only where the revisits are too many to be
    broadcast.  Of equal payloads the record with
    the largest page_id is the response; should that id occur twice, both are.
    Records without a page_id are responses.
    """
    hashed = pages.withColumn("digest", F.sha1("payload"))
    groups = hashed.filter((F.octet_length("payload") >= min_revisit) & F.col("page_id").isNotNull())
    groups = saved(groups.select("page_id", "digest").distinct(), "warc-digests")
    shared = (
        groups.groupBy("digest").agg(F.max("page_id").alias("first"), F.min("page_id").alias("last"))
        .filter("first > last").select("digest", "first")
    )
    again = looked_up(groups, saved(shared, "warc-shared"), ["digest"], "page_id").filter("page_id <> first")
    joined = hashed.join(saved(again, "warc-revisits"), ["page_id", "digest"], "left")
    revisit = F.col("first").isNotNull()
    return joined.select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT, date: str | None = None, roll: int = ROLL) -> DataFrame:
    """Write ``pages`` (page_id, url, payload binary) as archives below ``folder``; return the manifest.

    The manifest has a row (path, records) for each archive of the attempts
    that ended well, and is itself a table in the shared folder.  Null
    payloads are written as empty ones.  An empty table writes no archive.
    """
    when = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches):
        fs, base = _filesystem(folder)
        fs.create_dir(base, recursive=True)
        task = TaskContext.get()
        made, out, sink, name = [], None, None, ""

        def close():
            if out is not None:
                sink.close()
                made.append((f"{folder}/{name}", out.records))

        for batch in batches:
            columns = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            payloads = columns["payload"]
            for i, payload in enumerate(payloads):
                if out is None or out.size >= roll:
                    close()
                    sample, size = [], 0
                    for p in payloads[i:]:
                        if size > SAMPLE:
                            break
                        if p:
                            sample.append(p[:SAMPLE])
                            size += len(sample[-1])
                    name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{uuid.uuid4().hex}.warc.zst"
                    sink = fs.open_output_stream(f"{base}/{name}")
                    out = ArchiveWriter(sink, make_dictionary(sample))
                out.add(
                    record_bytes(
                        columns["kind"][i], columns["page_id"][i], columns["url"][i], payload or b"",
                        columns["digest"][i], columns["refers_to"][i], when,
                    )
                )
        close()
        if made:
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in made]), pa.array([n for _, n in made], pa.int64())], names=["path", "records"]
            )

    filled = pages.withColumn("payload", F.coalesce(F.col("payload"), F.lit(b"")))
    return saved(arrow_map(record_types(filled, min_revisit), run, "path string, records long"), "warc-manifest")


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives in ``manifest`` (path, records), a task per archive.

    Raises on a broken frame, header, length or digest, and where an archive
    does not hold the records that the manifest tells.  ``payloads=False``
    leaves url and payload null.
    """

    def run(batches):
        for batch in batches:
            for path, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, name = _filesystem(path)
                n, rows, size = 0, [], 0
                with fs.open_input_stream(name) as source:
                    for raw in read_frames(source):
                        try:
                            row = parse_record(raw)
                        except WarcError as e:
                            raise WarcError(f"{path}, record {n}: {e}") from e
                        n += 1
                        rows.append(row if payloads else row | {"url": None, "payload": None})
                        size += len(raw) if payloads else 200
                        if size > READ:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                if n != records:
                    raise WarcError(f"{path}: {n} records, {records} expected")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema(
        [
            ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary()),
        ]
    )
    archives = manifest.select("path", "records")
    return arrow_map(archives.repartition(max(1, archives.count())), run, SCHEMA)


def archive_round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write a record for each page to archives in the shared folder and read them all back."""
    named = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).cast("binary").alias("payload")
    )
    manifest = write_archives(named, scratch(pages.sparkSession, "warc"))
    return read_archives(manifest, payloads=False).drop("url", "payload")
