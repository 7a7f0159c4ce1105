"""SequenceFiles of text keys and values as a Spark data source.

    spark.dataSource.register(SequenceFileSource)
    spark.read.format("sequencefile").load("…/segment/*/metadata-*")

A file is cut into byte ranges. A task goes to the first sync marker in its range and reads on until
a marker that lies beyond it, so that every record is read once, whatever the size of the ranges. The
records' bytes go to Spark in Arrow batches; no row passes through Python's serialiser.

Rows are (key, value, file, error). With the option `errors` set to `report`, a range that cannot be
read gives a row with the reason (and the records before it) instead of ending the job.

Files are opened through pyarrow, which reaches local and mounted folders, HDFS (by its own library)
and the common object stores; for others there is `sources.read_sequence_rdd`.
"""

from __future__ import annotations

import bz2
import fnmatch
import gzip
import json
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SPLIT_BYTES = 128 << 20
#: Bytes read from a file at once, and of an Arrow batch.
READ_BYTES, BATCH_BYTES = 1 << 20, 4 << 20
BATCH_ROWS = 10_000
SCHEMA = "key STRING, value STRING, file STRING, error STRING"

# Fixed values of the file format.
MAGIC, TEXT = b"SEQ", "org.apache.hadoop.io.Text"
ESCAPE = b"\xff\xff\xff\xff"
SYNC_SIZE = 16
OLDEST, BLOCKS_FROM, CODECS_FROM, METADATA_FROM, NEWEST = 4, 4, 5, 6, 6
DEFAULT_CODEC = "org.apache.hadoop.io.compress.DefaultCodec"

_INTS = struct.Struct(">ii")
_INT = struct.Struct(">i")


class UnreadableFile(ValueError):
    """A file that is no SequenceFile of texts, or breaks off."""


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if not re.match(r"[a-z][a-z0-9+.-]*:", path):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def listed_files(pattern: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files a pattern names, in order; a folder stands for its files."""
    files, path = filesystem(pattern)
    prefix = pattern[: len(pattern) - len(path)] if pattern.endswith(path) else ""
    if pattern.startswith("file:"):
        prefix = "file:"
    parts = path.split("/")
    fixed = next((i for i, part in enumerate(parts) if re.search(r"[*?\[]", part)), len(parts))
    found = [files.get_file_info("/".join(parts[:fixed]) or "/")]
    for part in parts[fixed:]:
        inside = [
            info
            for folder in found
            if folder.type == pafs.FileType.Directory
            for info in files.get_file_info(pafs.FileSelector(folder.path))
        ]
        found = [info for info in inside if fnmatch.fnmatchcase(info.base_name, part)]
    out = []
    for info in found:
        if info.type == pafs.FileType.Directory:
            out += [
                i
                for i in files.get_file_info(pafs.FileSelector(info.path))
                if i.type == pafs.FileType.File and i.base_name[:1] not in ("_", ".")
            ]
        elif info.type == pafs.FileType.File:
            out.append(info)
    if not out:
        raise FileNotFoundError(f"{pattern}: no such files")
    return sorted((prefix + info.path, info.size) for info in out)


class Window:
    """A part of an open file in memory; positions are those of the file."""

    def __init__(self, file: pa.NativeFile, at: int) -> None:
        self.file, self.base, self.data = file, at, b""
        file.seek(at)

    def has(self, at: int, size: int) -> bool:
        """Whether the file has these bytes; afterwards `data` does too."""
        short = at + size - self.base - len(self.data)
        if short > 0:
            kept = self.data[at - self.base :] if at - self.base < len(self.data) else b""
            skipped = max(0, at - self.base - len(self.data))
            if skipped:
                self.file.seek(at)
            self.base = at
            parts, wanted = [kept], size - len(kept)
            while wanted > 0:
                more = self.file.read(max(READ_BYTES, wanted))
                if not more:
                    break
                parts.append(more)
                wanted -= len(more)
            self.data = b"".join(parts)
        return at + size <= self.base + len(self.data)

    def take(self, at: int, size: int) -> bytes:
        if size < 0 or not self.has(at, size):
            raise UnreadableFile(f"the file breaks off at byte {at}")
        return self.data[at - self.base : at - self.base + size]

    def find(self, pattern: bytes, at: int, before: int) -> int | None:
        """The first place from `at` on, and before `before`, where the pattern stands."""
        while at < before and self.has(at, len(pattern)):
            place = self.data.find(pattern, at - self.base)
            if place >= 0:
                return self.base + place if self.base + place < before else None
            at = self.base + len(self.data) - len(pattern) + 1
        return None


def vint(data: bytes, at: int) -> tuple[int, int]:
    """A number of variable length, and the place after it."""
    first = data[at] - 256 if data[at] > 127 else data[at]
    if first >= -112:
        return first, at + 1
    negative = first < -120
    end = at + 1 + (-120 - first if negative else -112 - first)
    if end > len(data):
        raise UnreadableFile("a number breaks off")
    value = int.from_bytes(data[at + 1 : end], "big")
    return (~value if negative else value), end


def _snappy(data: bytes) -> bytes:
    """Blocks of (size, pieces of (packed size, packed bytes))."""
    codec, out, at = pa.Codec("snappy"), [], 0
    while at < len(data):
        (size,) = _INT.unpack_from(data, at)
        at += 4
        while size > 0:
            (packed,) = _INT.unpack_from(data, at)
            piece = data[at + 4 : at + 4 + packed]
            own = shift = 0
            for byte in piece:
                own |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    break
            out.append(codec.decompress(piece, own, asbytes=True))
            size -= own
            at += 4 + packed
    return b"".join(out)


#: By the last part of the codec's class name.
CODECS = {
    "DefaultCodec": zlib.decompress,
    "GzipCodec": gzip.decompress,
    "BZip2Codec": bz2.decompress,
    "SnappyCodec": _snappy,
}


@dataclass(frozen=True)
class Header:
    unpack: object  # of a codec, or None
    blocks: bool
    sync: bytes
    end: int


def read_header(window: Window) -> Header:
    at = 0

    def take(size: int) -> bytes:
        nonlocal at
        at += size
        return window.take(at - size, size)

    def string() -> str:
        nonlocal at
        window.has(at, 9)
        size, end = vint(window.data[at - window.base : at - window.base + 9] or b"\0", 0)
        at += end
        return take(size).decode("utf-8", "replace")

    if take(3) != MAGIC:
        raise UnreadableFile("no SequenceFile")
    version = take(1)[0]
    if not OLDEST <= version <= NEWEST:
        raise UnreadableFile(f"version {version} is not supported")
    for kind in (string(), string()):
        if kind != TEXT:
            raise UnreadableFile(f"{kind} is not supported")
    packed, blocks = take(1) != b"\0", take(1) != b"\0"
    unpack = None
    if packed:
        name = string() if version >= CODECS_FROM else DEFAULT_CODEC
        unpack = CODECS.get(name.rpartition(".")[2])
        if unpack is None:
            raise UnreadableFile(f"{name} is not supported")
    if version >= METADATA_FROM:
        for _ in range(2 * _INT.unpack(take(4))[0]):
            string()
    sync = take(SYNC_SIZE)
    return Header(unpack, blocks, sync, at)


def _text(data: bytes) -> bytes:
    """The bytes of a serialised text."""
    size, at = vint(data, 0) if data else (0, 0)
    if size < 0 or at + size > len(data):
        raise UnreadableFile("a text breaks off")
    return data[at : at + size]


def read_range(window: Window, header: Header, start: int, end: int) -> Iterator[tuple[bytes, bytes]]:
    """The records behind the markers that begin from `start` on and before `end`. The first range
    also has those before the first marker."""
    at = header.end
    if start:
        found = window.find(ESCAPE + header.sync, max(start, header.end), end)
        if found is None:
            return
        at = found
    while window.has(at, 4):
        (size,) = _INT.unpack_from(window.data, at - window.base)
        if size == -1:
            if at >= end:
                return
            if window.take(at + 4, SYNC_SIZE) != header.sync:
                raise UnreadableFile(f"no marker at byte {at}")
            at += 4 + SYNC_SIZE
            if header.blocks:
                at = yield from _block(window, header, at)
            continue
        if header.blocks:
            raise UnreadableFile(f"no block at byte {at}")
        size, key_size = _INTS.unpack(window.take(at, 8))
        if not 0 <= key_size <= size:
            raise UnreadableFile(f"no record at byte {at}")
        record = window.take(at + 8, size)
        value = record[key_size:]
        yield _text(record[:key_size]), _text(header.unpack(value) if header.unpack else value)
        at += 8 + size
    if window.has(at, 1):
        raise UnreadableFile(f"the file breaks off at byte {at}")


def _block(window: Window, header: Header, at: int):
    """The records of a block; returns the place after it."""

    def number() -> int:
        nonlocal at
        window.has(at, 9)
        value, size = vint(window.data[at - window.base : at - window.base + 9] or b"\x8f", 0)
        at += size
        return value

    count = number()
    parts = []
    for _ in range(4):
        size = number()
        parts.append(header.unpack(window.take(at, size)) if size else b"")
        at += size
    key_sizes, keys, value_sizes, values = parts
    a = b = c = d = 0
    for _ in range(count):
        size, a = vint(key_sizes, a)
        key = _text(keys[b : b + size])
        b += size
        size, c = vint(value_sizes, c)
        yield key, _text(values[d : d + size])
        d += size
    return at


def strings(values: list[bytes]) -> pa.Array:
    """Bytes as texts; what is no UTF-8 is replaced as Java does it."""
    try:
        return pa.array(values, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([v.decode("utf-8", "replace") for v in values], pa.string())


class Range(InputPartition):
    def __init__(self, path: str, start: int, end: int) -> None:
        self.path, self.start, self.end = path, start, end


class SequenceFileReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        patterns = options.get("paths") or json.dumps([options["path"]])
        self.patterns = json.loads(patterns)
        self.split_bytes = int(options.get("splitBytes", SPLIT_BYTES))
        self.report = options.get("errors", "fail") == "report"

    def partitions(self) -> list[Range]:
        return [
            Range(path, start, min(start + self.split_bytes, size))
            for pattern in self.patterns
            for path, size in listed_files(pattern)
            for start in range(0, max(size, 1), self.split_bytes)
        ]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        keys, values, held = [], [], 0
        try:
            files, path = filesystem(part.path)
            with files.open_input_file(path) as file:
                window = Window(file, 0)
                header = read_header(window)
                if part.start > header.end:
                    window = Window(file, part.start)
                for key, value in read_range(window, header, part.start, part.end):
                    keys.append(key)
                    values.append(value)
                    held += len(key) + len(value)
                    if held >= BATCH_BYTES or len(keys) >= BATCH_ROWS:
                        yield self._batch(part, keys, values)
                        keys, values, held = [], [], 0
        except (OSError, ValueError, EOFError, struct.error, zlib.error, IndexError) as error:
            if not self.report:
                raise
            if keys:
                yield self._batch(part, keys, values)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(1, pa.string()), pa.nulls(1, pa.string()),
                    pa.array([part.path]), pa.array([f"{type(error).__name__}: {error}"]),
                ],
                ["key", "value", "file", "error"],
            )
            return
        if keys:
            yield self._batch(part, keys, values)

    def _batch(self, part: Range, keys: list[bytes], values: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                strings(keys), strings(values),
                pa.array([part.path] * len(keys)), pa.nulls(len(keys), pa.string()),
            ],
            ["key", "value", "file", "error"],
        )


class SequenceFileSource(DataSource):
    """Options: path, or paths as a JSON list of patterns; splitBytes; errors (fail or report)."""

    @classmethod
    def name(cls) -> str:
        return "sequencefile"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> SequenceFileReader:
        return SequenceFileReader(self.options)
