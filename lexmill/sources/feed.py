"""A feed of length-prefixed protocol buffers, decoded without generated classes."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lexmill.sinks.workspace import bounded_arrow_batches

COLUMNS = "url string, source string, title string, raw binary, epoch_ticks double"


def varint(data: bytes, at: int) -> tuple[int, int]:
    """A number of 7-bit groups and the place after it."""
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def messages(data: bytes) -> Iterator[bytes]:
    """Messages that each follow their length."""
    at = 0
    while at < len(data):
        size, at = varint(data, at)
        if at + size > len(data):
            raise ValueError("the feed ends within a message")
        yield data[at : at + size]
        at += size


def fields(message: bytes) -> dict[int, list[int | bytes]]:
    """Values by field number: numbers, or bytes of strings and nested messages."""
    found: dict[int, list[int | bytes]] = {}
    at = 0
    while at < len(message):
        tag, at = varint(message, at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(message, at)
        elif kind == 2:
            size, at = varint(message, at)
            value, at = message[at : at + size], at + size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = int.from_bytes(message[at : at + size], "little"), at + size
        else:
            raise ValueError(f"unknown wire type {kind}")
        found.setdefault(tag >> 3, []).append(value)
    return found


#: Field numbers: of a frame, its kind and body; of an entry, its parts.
FRAME = {"kind": 1, "entry": 2}
ENTRY = {"url": 1, "source": 2, "title": 3, "content": 4, "time": 5}
KIND_ENTRY, KIND_END = 1, 2


def _number(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _string(field: int, value: bytes) -> bytes:
    return _number(field << 3 | 2) + _number(len(value)) + value


def encode_frame(url: str, source: str, content: bytes, time: int) -> bytes:
    """A length-prefixed entry, as ``read_feed`` takes it."""
    entry = _string(ENTRY["url"], url.encode()) + _string(ENTRY["source"], source.encode()) + _string(ENTRY["content"], content) + _number(ENTRY["time"] << 3) + _number(time)
    body = _number(FRAME["kind"] << 3) + _number(KIND_ENTRY) + _string(FRAME["entry"], entry)
    return _number(len(body)) + body


def encode_end() -> bytes:
    body = _number(FRAME["kind"] << 3) + _number(KIND_END)
    return _number(len(body)) + body


def entries(data: bytes) -> Iterator[tuple]:
    """The rows of one file up to its end marker."""
    for m in messages(data):
        outer = fields(m)
        if outer.get(FRAME["kind"], [KIND_ENTRY])[0] == KIND_END:
            return
        e = fields(outer[FRAME["entry"]][0])
        text = lambda k, e=e: e[ENTRY[k]][0].decode("utf-8", "replace") if ENTRY[k] in e else None
        raw = e.get(ENTRY["content"], [b""])[0]
        try:
            raw = zlib.decompress(raw)
        except zlib.error:
            pass
        yield text("url"), text("source"), text("title"), raw, float(e.get(ENTRY["time"], [0])[0])


def decoded(files: Iterable[pa.Array], most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Entries of arrays of files in batches of about ``most`` bytes of inflated contents, whatever the size and number of files."""
    schema = pa.schema([("url", pa.string()), ("source", pa.string()), ("title", pa.string()), ("raw", pa.binary()), ("epoch_ticks", pa.float64())])
    rows, held = [], 0
    for contents in files:
        for content in contents:
            for row in entries(content.as_py()):
                rows.append(row)
                held += len(row[3]) + 100
                if held >= most:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


#: Parts of small files that one task reads one after the other.
FILE_PARTS = 16


def read_feed(spark: SparkSession, path: str, publisher: str | None = None) -> DataFrame:
    """Entries of feed files up to their end marker; compressed contents are inflated. ``publisher`` filters by source."""
    bounded_arrow_batches(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    # a part has few files, because opening one counts as megabytes
    parts = files.rdd.getNumPartitions()
    files = files.coalesce(max(1, min(parts, max(3 * spark.sparkContext.defaultParallelism, parts // FILE_PARTS))))
    rows = files.mapInArrow(lambda batches: decoded(b[0] for b in batches), COLUMNS)
    return rows.where(rows["source"] == publisher) if publisher else rows
