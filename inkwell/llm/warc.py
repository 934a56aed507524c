"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each of several whole records, and a
seek table in a skippable frame at its end (the Zstandard seekable format). The index
maps a record to its bundle, its frame and its offset in the uncompressed frame, so one
record is read by decompressing one frame.

Tasks write bundles into the shared folder under names of their own; only those of tasks
that succeeded are named by the index, so a repeated task does no harm. Paths are opened
with ``pyarrow.fs``, which knows the schemes of shared stores.

Of records with equal payloads of at least ``LEAST`` bytes, that with the largest page id
is the response and the others are revisits of it; all others are responses.

Defined results: a null html is an empty payload. Rows repeated under the largest id of
their payload are all responses. A row without an id is a response that nothing refers
to. A null url is written as ``urn:page:`` and the id. An empty table gives an empty
archive. Columns other than the three are not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm.shipping import map_batches
from inkwell.session import keep, scratch_path

LEAST = 1000
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 64 << 20
# Fixed values of the seekable format: the skippable frame's mark and the footer's.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
INDEX = "page_id bigint, record_id string, bundle string, frame int, offset bigint, length bigint"
RECORD = "page_id bigint, record_id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def planned(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """page_id, url, payload, payload_digest and refers_to (null: response) of each row.

    Groups are found on narrow rows; payloads are shuffled once, by the id, which no
    group of copies makes uneven.
    """
    rows = pages.select(
        F.col(key).cast("bigint").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")
    ).withColumn("payload_digest", F.sha1("payload"))
    narrow = rows.where(F.octet_length("payload") >= LEAST).select("page_id", "payload_digest")
    last = narrow.groupBy("payload_digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    revisits = narrow.join(last.drop("n"), "payload_digest").where("page_id < refers_to").distinct()
    return rows.join(revisits, ["page_id", "payload_digest"], "left")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One record: header, block and the empty lines that end it."""
    head = _HTTP % len(payload)
    block = head if refers_to is not None else head + payload
    target = f"urn:page:{page_id}" if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"X-Payload-Length: {len(payload)}",
        f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path with or without a scheme, and the path there."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


class BundleWriter:
    """Writes records into bundles; collects the index rows of what it has written."""

    def __init__(self, folder: str):
        self.folder, self.index = folder, []
        self.stream = None
        self.pending: list[tuple[int | None, str, int, int]] = []
        self.buffer, self.frames, self.size = io.BytesIO(), [], 0
        self.packer = zstandard.ZstdCompressor(level=3, write_checksum=True)

    def add(self, page_id: int | None, name: str, data: bytes) -> None:
        if self.stream is None:
            self.bundle = f"{self.folder}/{uuid.uuid4().hex}.warc.zst"
            system, path = opened(self.bundle)
            system.create_dir(path.rpartition("/")[0], recursive=True)
            self.stream, self.frames, self.size = system.open_output_stream(path, compression=None), [], 0
        self.pending.append((page_id, name, self.buffer.tell(), len(data)))
        self.buffer.write(data)
        if self.buffer.tell() >= FRAME_BYTES:
            self._frame()
        if self.size >= BUNDLE_BYTES:
            self.close()

    def _frame(self) -> None:
        raw = self.buffer.getvalue()
        packed = self.packer.compress(raw)
        self.stream.write(packed)
        self.index += [(p, name, self.bundle, len(self.frames), at, n) for p, name, at, n in self.pending]
        self.frames.append((len(packed), len(raw)))
        self.size += len(packed)
        self.pending, self.buffer = [], io.BytesIO()

    def close(self) -> None:
        """End the bundle with its seek table."""
        if self.stream is None:
            return
        if self.pending:
            self._frame()
        entries = b"".join(struct.pack("<II", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, _SEEKABLE)
        self.stream.write(struct.pack("<II", _SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.stream.close()
        self.stream = None


def seek_table(file: pa.NativeFile) -> list[tuple[int, int, int]]:
    """Start, packed size and size of each frame, from the end of the file."""
    end = file.size()
    file.seek(end - 9)
    count, flags, mark = struct.unpack("<IBI", file.read(9))
    if mark != _SEEKABLE:
        raise ValueError("no seek table at the end of the bundle")
    width = 12 if flags & 0x80 else 8
    file.seek(end - 9 - count * width)
    entries, at, out = file.read(count * width), 0, []
    for i in range(count):
        packed, size = struct.unpack_from("<II", entries, i * width)
        out.append((at, packed, size))
        at += packed
    return out


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Header fields, block and end of the record that starts at ``at``."""
    stop = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:stop].decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("no record starts here")
    fields = dict(line.split(": ", 1) for line in lines)
    end = stop + 4 + int(fields["Content-Length"])
    return fields, data[stop + 4 : end], end + 4


def _row(fields: dict[str, str], block: bytes) -> tuple:
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    size, kind = int(fields["X-Payload-Length"]), fields["WARC-Type"]
    if kind == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        if hashlib.sha1(payload).hexdigest() != digest or len(payload) != size:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    number = lambda name: int(fields[name]) if name in fields else None
    return number("X-Page-ID"), fields["WARC-Record-ID"], fields["WARC-Target-URI"], size, digest, kind, number("X-Refers-To-Page-ID")


def _batches(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_INDEX_ARROW = pa.schema(
    [("page_id", pa.int64()), ("record_id", pa.string()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]
)
_RECORD_ARROW = pa.schema(
    [
        ("page_id", pa.int64()), ("record_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ]
)


def write(pages: DataFrame, folder: str | None = None, key: str = "page_id") -> DataFrame:
    """Write the archive; returns its index, itself a table in the shared folder."""
    folder = folder or scratch_path(pages.sparkSession, "warc")

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = BundleWriter(folder)
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "payload_digest", "refers_to")]
            for values in zip(*columns):
                page_id, url, payload, digest, refers_to = (v.as_py() for v in values)
                writer.add(page_id, record_id(page_id, digest), record(page_id, url, payload, digest, refers_to))
            done, writer.index = writer.index, []
            yield from _batches(done, _INDEX_ARROW)
        writer.close()
        yield from _batches(writer.index, _INDEX_ARROW)

    return keep(map_batches(planned(pages, key), turn, INDEX), "warc-index")


def read(index: DataFrame) -> DataFrame:
    """All records of the archive's bundles, read frame by frame; payloads are verified."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for bundle in batch.column("bundle").to_pylist():
                system, path = opened(bundle)
                with system.open_input_file(path) as file:
                    for at, packed, size in seek_table(file):
                        file.seek(at)
                        data, place, rows = unpacker.decompress(file.read(packed), max_output_size=size), 0, []
                        while place < size:
                            fields, block, place = parse(data, place)
                            rows.append(_row(fields, block))
                        yield from _batches(rows, _RECORD_ARROW)

    bundles = index.select("bundle").distinct()
    return map_batches(bundles, turn, RECORD)


def lookup(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Records of the page ids in ``wanted`` (page_id): only their frames are read."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for bundle, frame, offset in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "offset"))):
                system, path = opened(bundle)
                with system.open_input_file(path) as file:
                    at, packed, size = seek_table(file)[frame]
                    file.seek(at)
                    data = unpacker.decompress(file.read(packed), max_output_size=size)
                fields, block, _ = parse(data, offset)
                rows.append(_row(fields, block))
            yield from _batches(rows, _RECORD_ARROW)

    return map_batches(index.join(wanted.select("page_id").distinct(), "page_id").drop("length"), turn, RECORD)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return read(write(pages))
