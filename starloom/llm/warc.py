"""WARC records in seekable Zstandard bundles."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import arrow_slices, column, ready_workers, stored, text_or_empty
from starloom.llm.files import read_files, write_files

#: Records are gathered into a frame until it holds so many bytes, frames into a bundle.
FRAME_BYTES = 128 << 10
BUNDLE_BYTES = 16 << 20
LEVEL = 3
#: Equal payloads of at least so many bytes are stored once.
REVISIT_BYTES = 1000
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the seekable format and of WARC 1.1.
SEEK_FRAME = 0x184D2A5E
INDEX_FRAME = 0x184D2A5D
SEEK_MAGIC = struct.pack("<I", 0x8F92EAB1)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_RECORDS = "page_id long, url string, record_type string, refers_to long, payload binary, "
_RECORDS += "payload_bytes long, payload_digest string, frame int, offset long"
_INDEX = "path string, record_id string, frame int, offset long, length long"


def _header(lines: dict[str, str | None]) -> bytes:
    given = (f"{name}: {value}\r\n" for name, value in lines.items() if value is not None)
    return "".join(given).encode() + b"\r\n"


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page_id(text: str | None) -> int | None:
    number = text and text.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number and number != "null" else None


def _digest(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def make_record(row: dict) -> bytes:
    """One record; a revisit has the headers of its payload only."""
    revisit = row["record_type"] == "revisit"
    payload = row["payload"] or b""
    block = b"HTTP/1.1 200 OK\r\n" + _header(
        {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(payload))}
    )
    if not revisit:
        block += payload
    url = row["url"]
    head = b"WARC/1.1\r\n" + _header(
        {
            "WARC-Type": row["record_type"],
            "WARC-Record-ID": record_id(row["page_id"]),
            "WARC-Date": DATE,
            "WARC-Target-URI": url and re.sub(r"[\r\n]", lambda c: f"%{ord(c[0]):02X}", url),
            "WARC-Payload-Digest": _digest(hashlib.sha1(payload).digest()),
            "WARC-Refers-To": record_id(row["refers_to"]) if revisit else None,
            "WARC-Profile": PROFILE if revisit else None,
            "Content-Type": "application/http;msgtype=response",
            "Content-Length": str(len(block)),
        }
    )
    return head + block + b"\r\n\r\n"


class Bundle:
    """Frames, the index of records, and the seek table."""

    def __init__(self) -> None:
        self.size = 0
        self._packer = zstandard.ZstdCompressor(level=LEVEL)
        self._frames: list[bytes] = []
        self._table: list[tuple[int, int]] = []
        self._open: list[bytes] = []
        self._open_bytes = 0
        self._index: dict[str, list] = {"id": [], "frame": [], "offset": [], "length": []}

    def add(self, name: str, record: bytes) -> None:
        place = (name, len(self._frames), self._open_bytes, len(record))
        for values, value in zip(self._index.values(), place):
            values.append(value)
        self._open.append(record)
        self._open_bytes += len(record)
        self.size += len(record)
        if self._open_bytes >= FRAME_BYTES:
            self._close_frame()

    def _close_frame(self) -> None:
        packed = self._packer.compress(b"".join(self._open))
        self._table.append((len(packed), self._open_bytes))
        self._frames.append(packed)
        self._open, self._open_bytes = [], 0

    def finish(self) -> bytes:
        """The bundle without the closing magic number, which the writer adds."""
        if self._open:
            self._close_frame()
        index = self._packer.compress(json.dumps(self._index).encode())
        index = struct.pack("<II", INDEX_FRAME, len(index)) + index
        table = [*self._table, (len(index), 0)]
        entries = b"".join(struct.pack("<II", *entry) for entry in table)
        seek = struct.pack("<II", SEEK_FRAME, len(entries) + 9) + entries
        return b"".join([*self._frames, index, seek, struct.pack("<IB", len(table), 0)])


class BundleReader:
    """Random access to a bundle by its seek table."""

    def __init__(self, content: bytes) -> None:
        count, flags, magic = struct.unpack("<IB4s", content[-9:])
        if magic != SEEK_MAGIC or flags:
            raise ValueError("not a seekable bundle of records")
        start = len(content) - 9 - 8 * count
        if struct.unpack("<II", content[start - 8 : start]) != (SEEK_FRAME, 8 * count + 9):
            raise ValueError("broken seek table")
        self._content, self._starts = memoryview(content), [0]
        for packed, _ in struct.iter_unpack("<II", content[start:-9]):
            self._starts.append(self._starts[-1] + packed)
        self.frames = count - 1
        self._unpacker = zstandard.ZstdDecompressor()

    def _packed(self, number: int) -> memoryview:
        return self._content[self._starts[number] : self._starts[number + 1]]

    def frame(self, number: int) -> bytes:
        return self._unpacker.decompress(self._packed(number))

    def index(self) -> dict[str, list]:
        """Record identifiers with their frame, offset in it, and length."""
        return json.loads(self._unpacker.decompress(self._packed(self.frames)[8:]))

    def record(self, name: str) -> bytes:
        """The first record of this identifier; only its frame is unpacked."""
        index = self.index()
        place = index["id"].index(name)
        offset = index["offset"][place]
        return self.frame(index["frame"][place])[offset : offset + index["length"][place]]


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}


def parse_record(data: bytes, start: int = 0) -> tuple[dict, int]:
    """The record that begins at ``start``, and where the next one does."""
    body = data.index(b"\r\n\r\n", start) + 4
    fields = _fields(data[start : body - 4])
    end = body + int(fields["content-length"])
    payload_start = data.index(b"\r\n\r\n", body) + 4
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:"))
    revisit = fields["warc-type"] == "revisit"
    payload = None if revisit else data[payload_start:end]
    size = int(_fields(data[body : payload_start - 4])["content-length"])
    if payload is not None and (len(payload) != size or hashlib.sha1(payload).digest() != digest):
        raise ValueError(f"{fields['warc-record-id']}: payload and digest differ")
    record = {
        "page_id": _page_id(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"],
        "refers_to": _page_id(fields.get("warc-refers-to")),
        "payload": payload,
        "payload_bytes": size,
        "payload_digest": digest.hex(),
    }
    return record, end + 4


def write_warc(
    df: DataFrame,
    path: str,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> None:
    """Write a record per row of ``df`` into seekable bundles under ``path``.

    Of rows with equal payloads of at least ``REVISIT_BYTES``, those of the largest id are
    responses and the others revisit it; smaller payloads are responses always. A null payload
    is empty. A null id loses against any other; where all ids of a group are null, all are
    responses. Rows repeated with their id are written as often as they occur. A null address is
    left out. An empty table gives bundles without records; other columns are not looked at.
    """
    ready_workers(df.sparkSession)
    rows = df.select(
        column(id_column).cast("long").alias("page_id"),
        column(url_column).cast("string").alias("url"),
        text_or_empty(html_column).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    groups = (
        rows.where(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max("page_id").alias("largest"), F.count("*").alias("size"))
        .where("size > 1")
        .select("digest", "largest")
    )
    revisit = ~F.col("page_id").eqNullSafe(F.col("largest")) & F.col("largest").isNotNull()
    # The other side has a row per payload and is a table, so Spark may split a hot payload.
    marked = rows.join(stored(groups, "payloads"), "digest", "left").select(
        "page_id",
        "url",
        "payload",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("largest")).alias("refers_to"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(bundle: Bundle) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"bundle": pa.array([bundle.finish()], pa.binary())})

        bundle = Bundle()
        for part in arrow_slices(batches, ["payload"]):
            for row in part.to_pylist():
                bundle.add(record_id(row["page_id"]), make_record(row))
                if bundle.size >= BUNDLE_BYTES:
                    yield closed(bundle)
                    bundle = Bundle()
        if bundle.size:
            yield closed(bundle)

    write_files(marked.mapInArrow(run, "bundle binary"), path, SEEK_MAGIC)


def _rows(batches: Iterator[pa.RecordBatch], schema: pa.Schema, of) -> Iterator[pa.RecordBatch]:
    for part in arrow_slices(batches, ["content"], 1):
        for row in part.to_pylist():
            for found in of(row["path"], BundleReader(row["content"])):
                yield pa.RecordBatch.from_pylist(found, schema)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """All records under ``path``, checked against their digests.

    ``page_id, url, record_type, refers_to, payload, payload_bytes, payload_digest, frame,
    offset``; a revisit has no payload, but the size and digest of the one it stands for.
    """
    ready_workers(spark)
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
         ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
         ("payload_digest", pa.string()), ("frame", pa.int32()), ("offset", pa.int64())]
    )

    def records(_: str, bundle: BundleReader) -> Iterator[list[dict]]:
        for number in range(bundle.frames):
            data, start, found = bundle.frame(number), 0, []
            while start < len(data):
                record, end = parse_record(data, start)
                found.append(record | {"frame": number, "offset": start})
                start = end
            yield found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _rows(batches, schema, records)

    return read_files(spark, path).mapInArrow(run, _RECORDS)


def record_index(spark: SparkSession, path: str) -> DataFrame:
    """``path, record_id, frame, offset, length`` of every record, from the bundles' indexes."""
    ready_workers(spark)
    schema = pa.schema(
        [("path", pa.string()), ("record_id", pa.string()), ("frame", pa.int32()),
         ("offset", pa.int64()), ("length", pa.int64())]
    )

    def entries(file: str, bundle: BundleReader) -> Iterator[list[dict]]:
        names = ("record_id", "frame", "offset", "length")
        yield [{"path": file} | dict(zip(names, x)) for x in zip(*bundle.index().values())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _rows(batches, schema, entries)

    return read_files(spark, path).mapInArrow(run, _INDEX)
