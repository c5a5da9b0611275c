import hashlib
import io
import struct

import pytest
import zstandard

from bibliospark.llm import warc
from bibliospark.llm.common import scratch

from .helpers import rows

PAGES = "page_id long, url string, html string"
COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def brute(pages):
    out, first = [], {}
    for p, _, html in pages:
        raw = (html or "").encode()
        if p is not None and len(raw) >= 1000:
            first[raw] = max(p, first.get(raw, p))
    for p, _, html in pages:
        raw = (html or "").encode()
        top = first.get(raw, p)
        again = p is not None and top != p
        out.append((p, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


def test_round_trip_and_edge_rows(spark):
    big, edge = "<p>é</p>" * 400, "x" * 1000
    pages = [(i, f"http://h/{i}", f"<html>{i}</html>" * 50) for i in range(40)]
    pages += [(100 + i, "http://copy/", big) for i in range(30)]
    pages += [(200, None, None), (201, "", ""), (202, "a\r\nWARC-Type: x", "short"), (203, "ü ñ", "short"), (204, "u", edge), (205, "u", edge), (206, "u", edge[:-1]), (207, "u", edge[:-1])]
    pages += [(None, "u", big), (208, "u", "z" * 3_000_000), (209, "u", "\r\n\r\nWARC/1.1\r\n\x00"), (1, "http://h/1", pages[1][2])]
    df = spark.createDataFrame(pages, PAGES).selectExpr("*", "'x' AS digest", "'k' AS kind", "1 AS first", "2 AS payload").repartition(5)
    assert rows(warc.archive_round_trip(df), *COLUMNS) == brute(pages)
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def test_payloads_and_urls_come_back(spark):
    pages = [(i, f"http://h/{i}?q=a b&c=é%20", "<html>" + "y" * (900 + i) + "</html>") for i in range(200)]
    df = spark.createDataFrame(pages, PAGES).selectExpr("page_id", "url", "cast(html AS binary) AS payload")
    folder = scratch(spark, "warc-test")
    manifest = warc.write_archives(df, folder, roll=4000, date="2020-01-01T00:00:00Z")
    assert manifest.count() > 4 and manifest.agg({"records": "sum"}).first()[0] == 200
    got = {r.page_id: (r.url, bytes(r.payload)) for r in warc.read_archives(manifest).collect()}
    assert got == {i: (u.replace(" ", "%20").replace("é", "%C3%A9"), h.encode()) for i, u, h in pages}


def archive(payloads, dictionary=b""):
    sink = io.BytesIO()
    out = warc.ArchiveWriter(sink, dictionary)
    for i, p in enumerate(payloads):
        out.add(warc.record_bytes("response", i, f"http://h/{i}", p, hashlib.sha1(p).hexdigest(), None, "2020-01-01T00:00:00Z"))
    return sink.getvalue()


def test_format_of_an_archive():
    payloads = [f"<html>{i} the same words in every page</html>".encode() * 20 for i in range(300)]
    dictionary = warc.make_dictionary(payloads)
    raw = archive(payloads, dictionary)
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == 0x184D2A5D and raw[8 : 8 + size] == dictionary and len(dictionary) > 0
    at, frames = 8 + size, 0
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    while at < len(raw):  # frame by frame, by another way than read_frames
        one = decoder.decompressobj()
        assert one.decompress(raw[at:]).startswith(b"WARC/1.1\r\n")
        at, frames = len(raw) - len(one.unused_data), frames + 1
    assert frames == 300
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompress(raw[8 + size :])
    assert [warc.parse_record(f)["payload"] for f in warc.read_frames(io.BytesIO(raw))] == payloads


@pytest.mark.parametrize("read", [1, 7, 1 << 20])
def test_reads_of_any_size(monkeypatch, read):
    monkeypatch.setattr(warc, "READ", read)
    payloads = [b"", b"a", b"b" * 5000]
    assert [warc.parse_record(f)["payload"] for f in warc.read_frames(io.BytesIO(archive(payloads)))] == payloads


def test_broken_archives_are_told():
    raw = archive([b"payload " * 100, b"another"])
    read = lambda x: [warc.parse_record(f) for f in warc.read_frames(io.BytesIO(x))]
    assert len(read(raw)) == 2
    for broken in (raw[8:], raw[:-3], raw[:6], raw + b"\x00" * 8, raw[:30] + bytes([raw[30] ^ 255]) + raw[31:], raw[:-20] + raw[-19:]):
        with pytest.raises((warc.WarcError, struct.error)):
            read(broken)


def test_broken_records_are_told():
    good = warc.record_bytes("response", 1, "http://h/", b"payload", hashlib.sha1(b"payload").hexdigest(), None, "2020-01-01T00:00:00Z")
    assert warc.parse_record(good)["page_id"] == 1
    for old, new in [
        (b"WARC/1.1", b"WARC/0.9"), (b"payload\r\n", b"pay1oad\r\n"), (b"payload\r\n", b"payloads\r\n"), (b"\r\n\r\n", b"\r\n", ),
        (b"WARC-Date: 2020", b"WARC-Date: soon"), (b"WARC-Type: response", b"WARC-Type: other"), (b"WARC-Record-ID", b"X-ID"),
        (b"urn:page:1", b"urn:other:1"), (b"Content-Length: 7", b"Content-Length: 8"), (b"WARC-Date:", b"WARC-Date"),
        (b"WARC-Type: response", b"WARC-Type: revisit"),
    ]:
        with pytest.raises((warc.WarcError, ValueError)):
            warc.parse_record(good.replace(old, new, 1))
