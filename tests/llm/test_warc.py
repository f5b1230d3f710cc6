"""WARC: round trips, the dictionary frame, and archives that must be refused."""

import io
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from stratum.llm import warc as W
from stratum.llm.common import Scratch


class Out(io.BytesIO):
    def close(self):
        pass


def archive(records, level=3):
    out = Out()
    writer = W.Writer(out, level)
    for r in records:
        writer.add(r)
    writer.close()
    return out.getvalue()


def record(i, payload, **k):
    return W.record_bytes(i, f"http://x/{i}", payload, W.digest(payload), k.get("refers_to"), "refers_to" in k)


RECORDS = [record(i, f"<html>page {i} ".encode() * (i % 50 + 1)) for i in range(60)]


def test_round_trip_with_a_dictionary():
    data = archive(RECORDS)
    assert struct.unpack("<I", data[:4])[0] == 0x184D2A5D
    got = list(W.read_frames(io.BytesIO(data), "a"))
    assert [r for _, r in got] == RECORDS
    offset, third = got[2]
    size = struct.unpack("<I", data[4:8])[0]
    alone = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size])).decompressobj().decompress(data[offset:])
    assert alone == third


def test_dictionary_may_be_compressed_or_missing():
    data = archive(RECORDS)
    size = struct.unpack("<I", data[4:8])[0]
    packed = zstandard.ZstdCompressor().compress(data[8:8 + size])
    again = struct.pack("<II", 0x184D2A5D, len(packed)) + packed + data[8 + size:]
    assert [r for _, r in W.read_frames(io.BytesIO(again), "a")] == RECORDS
    few = archive(RECORDS[:3])
    assert few[:4] == W.FRAME and [r for _, r in W.read_frames(io.BytesIO(few), "a")] == RECORDS[:3]
    assert list(W.read_frames(io.BytesIO(b""), "a")) == []


@pytest.mark.parametrize("spoil", [lambda d: d[:-3], lambda d: d[:len(d) // 2], lambda d: d + b"junk", lambda d: d[:-20] + b"\0" * 20])
def test_damaged_archives_are_refused(spoil):
    with pytest.raises(W.ArchiveError):
        for _, r in W.read_frames(io.BytesIO(spoil(archive(RECORDS))), "a"):
            W.parse_record(r, "a")


@pytest.mark.parametrize("old,new", [(b"WARC/1.1", b"WARC/9.9"), (b"Content-Length: ", b"Content-Length: 9"), (b"WARC-Date", b"WARC-Dote"), (b"<html>", b"<htmL>"),
                                     (b"\r\n\r\n", b"\r\n"), (b"WARC-Type: ", b"WARC-Type ")])
def test_invalid_records_are_refused(old, new):
    with pytest.raises(W.ArchiveError):
        W.parse_record(RECORDS[3].replace(old, new, 1), "a")


def test_pages_round_trip(spark):
    pages = [(1, "u", "same"), (2, "u\r\nX: y", "same"), (9, None, "same"), (3, "u", None), (4, "u", ""), (5, "ü", "é" * 200_000), (2, "u", "same"), (None, "u", "same"), (7, "u", "a\r\n\r\nb")]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id bigint, url string, html string, digest string")
    scratch = Scratch(spark, "t")
    manifest = W.archived(df, scratch.path("archives"))
    got = sorted(((r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"], r["payload"]) for r in W.read_archives(manifest).collect()), key=str)
    first = {"same": 1, "": 3}
    want = []
    for i, _, html in pages:
        body = (html or "").encode()
        f = first.get(html or "", i)
        revisit = i is not None and i != f
        want.append((i or 0, "revisit" if revisit else "response", f if revisit else None, len(body), W.digest(body), None if revisit else body))
    assert [(*g[:5], None if g[5] is None else bytes(g[5])) for g in got] == sorted(want, key=str)
    for r in manifest.collect():
        with open(r["path"].removeprefix("file://"), "rb") as f:
            data = f.read()
        assert len(data) == r["bytes"] and sum(1 for _ in W.read_frames(io.BytesIO(data), "a")) == r["records"]
    assert W.read_archives(W.archived(df.limit(0))).count() == 0
    assert df.select(W.base32_sha1(F.lit(b"abc")).alias("x")).first()["x"] == W.digest(b"abc")
    only_long = W.archived(df, least_bytes=10)
    assert W.read_archives(only_long).where("record_type = 'revisit'").count() == 0
