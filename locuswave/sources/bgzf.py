"""Lines of gzip and blocked-gzip (bgzip) text, the blocked kind read by many tasks.

A bgzip file is a row of gzip members of at most 64 KiB, each of which states its own length.  The planner only lists
files and cuts them at byte offsets.  A task looks for the first member that begins at or after its offset, reads member
by member up to its end, and gives the lines that begin in its members; a line that runs on is completed from the members
behind, and the piece before the first line break belongs to the task before.  Each task also inflates the first member
behind its end, so that between them the tasks prove every member: a damaged one raises instead of being skipped.

Ordinary gzip cannot be entered in the middle: such a file is one task, streamed.

Columns: ``path``, ``split`` (offset at which the task's part begins), ``line_in_split`` (from 0) and ``line``.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from locuswave.files import file_system

SUFFIXES = (".gz", ".bgz", ".bgzf")
SPLIT_BYTES = 64 << 20
# Lines per Arrow batch, and how much an ordinary gzip file is read at a time.
BATCH_LINES = 20_000
CHUNK = 1 << 20

# The member header of the blocked format (RFC 1952 with the extra field "BC" of two bytes).
MAGIC = b"\x1f\x8b\x08\x04"
FIELD = b"BC\x02\x00"
LARGEST_MEMBER = 1 << 16
END_MARKER = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")

SCHEMA = "path string, split bigint, line_in_split bigint, line string"


def member_length(head: bytes) -> int | None:
    """Length of the member that begins with ``head``, None if that is no header of a blocked file."""
    if len(head) < 18 or head[:4] != MAGIC:
        return None
    extra = head[12:12 + struct.unpack("<H", head[10:12])[0]]
    while len(extra) >= 6:
        (size,) = struct.unpack("<H", extra[2:4])
        if extra[:4] == FIELD:
            return struct.unpack("<H", extra[4:6])[0] + 1
        extra = extra[4 + size:]
    return None


def make_member(data: bytes, level: int = 6) -> bytes:
    """One member; ``data`` has at most 65,280 bytes, so that even incompressible data fits."""
    body = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = body.compress(data) + body.flush()
    head = MAGIC + b"\0\0\0\0\0\xff\x06\0" + FIELD + struct.pack("<H", len(packed) + 25)
    return head + packed + struct.pack("<II", zlib.crc32(data), len(data))


@dataclass
class Part(InputPartition):
    path: str
    start: int
    stop: int
    blocked: bool

    def __init__(self, path: str, start: int, stop: int, blocked: bool) -> None:
        super().__init__(None)
        self.path, self.start, self.stop, self.blocked = path, start, stop, blocked


class Members:
    """Members of one file from a byte offset on."""

    def __init__(self, file, path: str, size: int) -> None:
        self.file, self.path, self.size = file, path, size
        self._at, self._held = 0, b""

    def _read(self, at: int, count: int) -> bytes:
        if not self._at <= at <= at + count <= self._at + len(self._held):
            self.file.seek(at)
            self._at, self._held = at, self.file.read(max(count, CHUNK))
        return self._held[at - self._at:at - self._at + count]

    def inflate(self, at: int) -> tuple[bytes, int]:
        """Text of the member at ``at`` and the offset behind it; raises unless it is whole and undamaged."""
        data = self._read(at, LARGEST_MEMBER + 18)
        length = member_length(data)
        if length is None or length > len(data):
            raise ValueError(f"damaged or cut block at byte {at} of {self.path}")
        try:
            inflater = zlib.decompressobj(31)
            text = inflater.decompress(data[:length])
        except zlib.error as error:
            raise ValueError(f"damaged block at byte {at} of {self.path}: {error}") from error
        if not inflater.eof or inflater.unused_data:
            raise ValueError(f"damaged block at byte {at} of {self.path}")
        return text, at + length

    def first_from(self, start: int, stop: int) -> int | None:
        """Offset of the first member that begins in [start, stop)."""
        if start == 0:
            return 0
        at = start
        while at < stop:
            data = self._read(at, 4 * LARGEST_MEMBER)
            found = data.find(MAGIC)
            while found >= 0:
                if at + found >= stop:
                    return None
                if self._is_member(at + found, data[found:found + LARGEST_MEMBER]):
                    return at + found
                found = data.find(MAGIC, found + 1)
            at += max(len(data) - len(MAGIC) + 1, 1)
        return None

    def _is_member(self, at: int, head: bytes) -> bool:
        if member_length(head if len(head) >= 64 else self._read(at, 64)) is None:
            return False
        try:
            self.inflate(at)
            return True
        except ValueError:
            # The bytes of a header also occur by chance inside packed data; a damaged member is told by the
            # task before, which inflates the first member behind its end.
            return False

    def lines(self, start: int, stop: int) -> Iterator[str]:
        """Lines that begin in the members of [start, stop), the first of a file included."""
        at = self.first_from(start, stop)
        if at is None:
            return
        open_, skip = Line(), at > 0
        while at < self.size:
            behind = at >= stop
            text, at = self.inflate(at)
            if behind and skip:
                return
            if skip:
                _, found, text = text.partition(b"\n")
                if not found:
                    continue
                skip = False
            for line in open_.fed(text):
                yield line
                if behind:  # only the open line is completed; one that begins exactly here still belongs to this task
                    return
        if not skip:
            yield from open_.rest()


class Line:
    """The open line of a stream of pieces; a line of any length is put together once."""

    def __init__(self) -> None:
        self.pieces: list[bytes] = []

    def fed(self, text: bytes) -> Iterator[str]:
        *whole, last = text.split(b"\n")
        for line in whole:
            self.pieces.append(line)
            yield _shown(b"".join(self.pieces))
            self.pieces = []
        self.pieces.append(last)

    def rest(self) -> Iterator[str]:
        if line := b"".join(self.pieces):
            yield _shown(line)


def _shown(line: bytes) -> str:
    return line.removesuffix(b"\r").decode("utf-8", "replace")


def _streamed(file, path: str) -> Iterator[str]:
    """Lines of an ordinary gzip file with any number of members."""
    inflater, open_, fed = zlib.decompressobj(31), Line(), False
    while data := file.read(CHUNK):
        while data:
            if inflater.eof:
                if not data.strip(b"\0"):  # padding behind the last member
                    break
                inflater, fed = zlib.decompressobj(31), False
            try:
                text = inflater.decompress(data)
            except zlib.error as error:
                raise ValueError(f"damaged gzip file {path}: {error}") from error
            fed, data = True, inflater.unused_data
            yield from open_.fed(text)
    if fed and not inflater.eof:
        raise ValueError(f"cut gzip file {path}")
    yield from open_.rest()


class _Reader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]], split_bytes: int) -> None:
        self.files, self.split_bytes = files, split_bytes

    def partitions(self) -> Sequence[InputPartition]:
        parts = []
        for path, size in self.files:
            system, place = file_system(path)
            with system.open_input_file(place) as file:
                blocked = member_length(file.read(64)) is not None
            step = self.split_bytes if blocked else max(size, 1)
            parts += [Part(path, start, min(start + step, size), blocked) for start in range(0, size, step)]
        return parts

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        system, place = file_system(part.path)
        with system.open_input_file(place) as file:
            lines = (Members(file, part.path, file.size()).lines(part.start, part.stop) if part.blocked
                     else _streamed(file, part.path))
            count, batch = 0, []
            for line in lines:
                batch.append(line)
                if len(batch) == BATCH_LINES:
                    yield self._batch(part, count, batch)
                    count, batch = count + len(batch), []
            if batch:
                yield self._batch(part, count, batch)

    @staticmethod
    def _batch(part: Part, count: int, lines: list[str]) -> pa.RecordBatch:
        n = len(lines)
        return pa.RecordBatch.from_arrays(
            [pa.array([part.path] * n), pa.array([part.start] * n, pa.int64()),
             pa.array(range(count, count + n), pa.int64()), pa.array(lines, pa.string())],
            names=["path", "split", "line_in_split", "line"])


class CompressedLines(DataSource):
    """Options: ``files``, a JSON list of [path, length], and ``split_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "compressed_lines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        files = [tuple(f) for f in json.loads(self.options["files"])]
        return _Reader(files, int(self.options.get("split_bytes", SPLIT_BYTES)))


def compressed_lines(spark: SparkSession, files: Sequence[tuple[str, int]], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    spark.dataSource.register(CompressedLines)
    return spark.read.format("compressed_lines").option("files", json.dumps([list(f) for f in files])).option(
        "split_bytes", split_bytes).load()
