"""WARC archives compressed with Zstandard and a dictionary.

An archive starts with a skippable frame that holds the dictionary; then every record is a
frame of its own, so that any record can be decoded from its offset alone.  Writing: records
of equal payload are found by their digests first; that of the smallest id is the response
and the others revisit it.  Each task writes archives of about ``ARCHIVE`` bytes into the
shared folder and returns a manifest row for each; only archives in the manifest count, so
files that a lost task left behind are never read.  Reading streams an archive frame by
frame, and checks versions, named fields, lengths, record ends and digests.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from stratum.llm.common import Scratch

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

ARCHIVE = 32 << 20              # compressed bytes after which an archive is closed
DICTIONARY = 64 << 10
TRAINING = (400, 4 << 20)       # leading records of an archive, and bytes, that the dictionary is trained on
READ = 1 << 20
EPOCH = "1970-01-01T00:00:00Z"


class ArchiveError(ValueError):
    """A record that is not valid; the message names the archive and the offset."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest_: str, refers_to: int | None, revisit: bool, date: str = EPOCH) -> bytes:
    """A response or revisit record: its payload is an HTTP response; a revisit holds the HTTP header only."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
              ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest_}"), ("WARC-Block-Digest", f"sha1:{digest(block)}"),
              ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return head + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, where: str) -> dict:
    """Named fields, payload (None for a revisit) and payload length of one record; raises ``ArchiveError``."""
    def check(ok: bool, what: str) -> None:
        if not ok:
            raise ArchiveError(f"{where}: {what}")

    end = data.find(b"\r\n\r\n")
    check(end > 0, "no end of the named fields")
    first, *lines = data[:end].split(b"\r\n")
    check(first in (b"WARC/1.0", VERSION), f"version {first[:20]!r}")
    fields: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        check(bool(colon) and name.strip() == name and bool(name), f"field {line[:40]!r}")
        fields[name.decode().lower()] = value.strip().decode()
    for name in REQUIRED:
        check(name in fields, f"no {name}")
    check(fields["content-length"].isdigit(), "content-length is no number")
    size = int(fields["content-length"])
    block = data[end + 4:end + 4 + size]
    check(len(block) == size and data[end + 4 + size:] == b"\r\n\r\n", f"content-length {size} does not fit the record")
    if "warc-block-digest" in fields:
        check(fields["warc-block-digest"] == f"sha1:{digest(block)}", "block digest")
    out = {"fields": fields, "block": block, "payload": None, "payload_bytes": None}
    if fields["warc-type"] in ("response", "revisit"):
        cut = block.find(b"\r\n\r\n")
        check(cut > 0 and block.startswith(b"HTTP/"), "no HTTP header")
        http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in block[:cut].split(b"\r\n")[1:])}
        check(http.get(b"content-length", b"").isdigit(), "no HTTP content-length")
        out["payload_bytes"] = int(http[b"content-length"])
        if fields["warc-type"] == "response":
            out["payload"] = block[cut + 4:]
            check(len(out["payload"]) == out["payload_bytes"], "HTTP content-length does not fit the payload")
            if "warc-payload-digest" in fields:
                check(fields["warc-payload-digest"] == f"sha1:{digest(out['payload'])}", "payload digest")
        else:
            check("warc-refers-to" in fields and "warc-payload-digest" in fields, "revisit without the record or digest it refers to")
    return out


def _page(urn: str, where: str) -> int | None:
    if not (urn.startswith("<urn:page:") and urn.endswith(">")):
        raise ArchiveError(f"{where}: record id {urn[:60]}")
    return int(urn[10:-1]) if urn[10:-1] else None


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary, or nothing where the records are too few for one."""
    samples = [s[:DICTIONARY] for s in samples if len(s) >= 8]
    if len(samples) < 16:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


class Writer:
    """Writes records to one archive; the first ones wait until the dictionary is trained."""

    def __init__(self, out, level: int):
        self.out, self.level, self.waiting, self.held = out, level, [], 0
        self.compressor, self.size, self.records = None, 0, 0

    def add(self, record: bytes) -> None:
        self.records += 1
        if self.compressor is None:
            self.waiting.append(record)
            self.held += len(record)
            if len(self.waiting) >= TRAINING[0] or self.held >= TRAINING[1]:
                self._start()
            return
        self._put(self.compressor.compress(record))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def _start(self) -> None:
        data = train_dictionary(self.waiting)
        dictionary = zstandard.ZstdCompressionDict(data) if data else None
        self.compressor = zstandard.ZstdCompressor(level=self.level, dict_data=dictionary, write_checksum=True, write_content_size=True)
        if data:
            self._put(struct.pack("<II", DICTIONARY_FRAME, len(data)) + data)
        for record in self.waiting:
            self._put(self.compressor.compress(record))
        self.waiting = []

    def close(self) -> None:
        if self.compressor is None:
            self._start()
        self.out.close()


def read_frames(stream, where: str) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of every frame after the dictionary; holds one record and a read buffer."""
    head = stream.read(8)
    dictionary, buffer, offset = None, head, 0
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_FRAME:
        size = struct.unpack("<I", head[4:])[0]
        data = stream.read(size)
        if len(data) != size:
            raise ArchiveError(f"{where}: the dictionary's frame is cut off")
        if data[:4] == FRAME:                   # a dictionary may itself be compressed
            data = zstandard.ZstdDecompressor().decompress(data)
        dictionary, buffer, offset = zstandard.ZstdCompressionDict(data), b"", 8 + size
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        buffer = buffer or stream.read(READ)
        if not buffer:
            return
        if len(buffer) < 4:
            buffer += stream.read(READ)
        if buffer[:4] != FRAME:
            raise ArchiveError(f"{where}+{offset}: no frame")
        frame, parts, used = decompressor.decompressobj(), [], 0
        while True:
            try:
                parts.append(frame.decompress(buffer))
            except zstandard.ZstdError as e:
                raise ArchiveError(f"{where}+{offset}: {e}") from e
            used += len(buffer)
            if frame.eof:
                rest = frame.unused_data
                break
            buffer = stream.read(READ)
            if not buffer:
                raise ArchiveError(f"{where}+{offset}: the frame is cut off")
        yield offset, b"".join(parts)
        offset, buffer = offset + used - len(rest), rest


def _open(path: str):
    return pyarrow.fs.FileSystem.from_uri(path)


def write_archives(records: DataFrame, folder: str, level: int = 3) -> DataFrame:
    """Manifest (path, records, bytes) of archives of ``records`` (page_id, url, payload, digest, refers_to, revisit)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer, path, done = TaskContext.get().partitionId(), None, "", []

        def close() -> None:
            writer.close()
            done.append((path, writer.records, writer.size))

        for b in batches:
            for row in zip(*(b.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to", "revisit"))):
                if writer is None:
                    # another name for each attempt: a file is never written twice
                    path = f"{folder}/{part:06d}-{len(done):04d}-{uuid.uuid4().hex[:12]}.warc.zst"
                    fs, at = _open(path)
                    fs.create_dir(at.rpartition("/")[0], recursive=True)
                    # as they are: the name's ending must not make the stream compress again
                    writer = Writer(fs.open_output_stream(at, compression=None), level)
                page_id, url, payload, digest_, refers_to, revisit = (x.as_py() for x in row)
                writer.add(record_bytes(page_id, url, payload, digest_, refers_to, revisit))
                if writer.size >= ARCHIVE:
                    close()
                    writer = None
        if writer is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["path", "records", "bytes"])

    return records.mapInArrow(run, "path string, records bigint, bytes bigint")


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """A row per record: page_id, url, payload (null for revisits), payload_bytes, payload_digest, record_type, refers_to, archive, offset.

    ``manifest`` has a column path (any address that the workers' file systems open) and may
    have records, which is then checked.  Invalid archives raise ``ArchiveError``.
    """
    counted = "records" in manifest.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, path in enumerate(b.column("path").to_pylist()):
                rows, held, total = [], 0, 0
                fs, at = _open(path)
                with fs.open_input_stream(at, compression=None) as stream:
                    for offset, data in read_frames(stream, path):
                        r = parse_record(data, f"{path}+{offset}")
                        f = r["fields"]
                        revisit = f["warc-type"] == "revisit"
                        rows.append((_page(f["warc-record-id"], path), f.get("warc-target-uri"), r["payload"] if with_payload else None, r["payload_bytes"],
                                     f["warc-payload-digest"].removeprefix("sha1:"), f["warc-type"], _page(f["warc-refers-to"], path) if revisit else None, path, offset))
                        held, total = held + len(data), total + 1
                        if held >= 8 << 20 or len(rows) >= 5000:
                            yield out(rows)
                            rows, held = [], 0
                if counted and total != b.column("records")[i].as_py():
                    raise ArchiveError(f"{path}: {total} records, the manifest has {b.column('records')[i]}")
                if rows:
                    yield out(rows)

    names = ("page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "offset")
    kinds = (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=list(names))

    types = "bigint string binary bigint string string bigint string bigint".split()
    own = manifest.select("path", *["records"] * counted)
    return own.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in zip(names, types)))


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1, five hexadecimal digits to four characters."""
    hexed = F.sha1(payload)
    pairs = []
    for k in range(0, 40, 5):
        value = F.conv(F.substring(hexed, k + 1, 5), 16, 10).cast("int")
        pairs += [F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), F.shiftright(value, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*pairs)


def records_of(pages: DataFrame, scratch: Scratch, *, id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """The frame that ``write_archives`` takes: responses, and revisits of equal payloads of at least ``least_bytes``.

    Null html is the empty payload.  The response of equal payloads is the row of the smallest
    id; rows that tie on it are all responses, and so are rows without id.
    """
    own = pages.select(F.col(id).cast("bigint").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    own = own.select("*", base32_sha1(F.col("payload")).alias("digest"), F.length("payload").alias("size"))
    # a digest that very many pages share is combined before the shuffle; the table of shared digests is written, so that
    # Spark knows its size: payloads are shuffled only where it is too large to broadcast, and that join's skew is split
    first = scratch.keep(own.where(F.col("size") >= least_bytes).groupBy("digest", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
                         .where("n > 1").select("digest", "size", "first"), "shared")
    revisit = F.coalesce(F.col("page_id") > F.col("first"), F.lit(False))
    return own.join(first, ["digest", "size"], "left").select("page_id", "url", "payload", "digest", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))


def archived(pages: DataFrame, folder: str | None = None, *, id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """Writes the pages' archives and returns the manifest, itself a written table."""
    scratch = Scratch(pages.sparkSession, "warc")
    return scratch.keep(write_archives(records_of(pages, scratch, id=id, url=url, html=html, least_bytes=least_bytes), folder or scratch.path("archives")), "manifest")
