"""Writers of files that Spark's own writers cannot make: files named by a column, and blocked gzip text.

Tasks write below ``_attempts`` under names of their own; the commit step moves the files of the successful attempts to
their places, so that a repeated or lost task leaves nothing behind.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from locuswave.files import file_system
from locuswave.sources.bgzf import END_MARKER, make_member

# Text per block: what the common tools put into one.
BLOCK = 65_280


@dataclass
class Moved(WriterCommitMessage):
    """Files of one task: where they are, and their places below the target."""

    made: list[tuple[str, str]]


class _Attempts(DataSourceArrowWriter):
    def __init__(self, path: str, suffix: str, overwrite: bool) -> None:
        self.path, self.suffix, self.overwrite = path, suffix, overwrite

    def _new(self, name: str, made: list[tuple[str, str]]):
        system, root = file_system(self.path)
        place = f"{root}/_attempts/{uuid.uuid4().hex}"
        system.create_dir(f"{root}/_attempts", recursive=True)
        made.append((place, name))
        return system.open_output_stream(place, compression=None)

    def commit(self, messages: list[WriterCommitMessage]) -> None:
        system, root = file_system(self.path)
        system.create_dir(root, recursive=True)
        for message in messages:
            for place, name in message.made if message else []:
                system.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
                system.move(place, f"{root}/{name}")
        self._end(system, root)
        with system.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages: list[WriterCommitMessage]) -> None:
        self._end(*file_system(self.path))

    def _end(self, system: fs.FileSystem, root: str) -> None:
        if system.get_file_info(f"{root}/_attempts").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/_attempts")


class _NamedWriter(_Attempts):
    def write(self, iterator: Iterator[pa.RecordBatch]) -> Moved:
        made: list[tuple[str, str]] = []
        for batch in iterator:
            for name, content in zip(batch.column("name"), batch.column("content")):
                with self._new(name.as_py(), made) as out:
                    out.write(content.as_py().encode())
        return Moved(made)


class _BlockedWriter(_Attempts):
    def write(self, iterator: Iterator[pa.RecordBatch]) -> Moved:
        made: list[tuple[str, str]] = []
        part = TaskContext.get().partitionId()
        open_, out, held = None, None, bytearray()

        def end() -> None:
            if out is not None:
                if held:
                    out.write(make_member(bytes(held)))
                out.write(END_MARKER)
                out.close()

        for batch in iterator:
            for folder, head, line in zip(*(batch.column(c).to_pylist() for c in ("folder", "head", "line"))):
                if folder != open_:
                    end()
                    out = self._new(f"{folder}/part-{part:05d}.{self.suffix}", made)
                    open_, held = folder, bytearray() if head is None else bytearray(head.encode() + b"\n")
                held += line.encode() + b"\n"
                while len(held) >= BLOCK:
                    out.write(make_member(bytes(held[:BLOCK])))
                    del held[:BLOCK]
        end()
        return Moved(made)


class NamedFiles(DataSource):
    """One file per row: ``name``, a path below the target, and ``content``."""

    writer_class = _NamedWriter

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema, overwrite: bool) -> _Attempts:
        return self.writer_class(self.options["path"], self.options.get("suffix", ""), overwrite)


class BlockedGzip(NamedFiles):
    """Rows ``folder``, ``head``, ``line``, sorted by folder in each task: one file per task and folder.

    A file begins with the head of its first row, unless that is NULL.
    """

    writer_class = _BlockedWriter

    @classmethod
    def name(cls) -> str:
        return "blocked_gzip"


def write_named(rows: DataFrame, path: str) -> None:
    """Each row's ``content`` as the UTF-8 file ``name`` below ``path``; names are unique, existing files are replaced."""
    _save(rows.select("name", "content"), NamedFiles, path, "")


def write_blocked_gzip(rows: DataFrame, path: str, suffix: str) -> None:
    head = F.col("head") if "head" in rows.columns else F.lit(None).cast("string").alias("head")
    _save(rows.select("folder", head, "line"), BlockedGzip, path, suffix)


def _save(rows: DataFrame, kind: type[NamedFiles], path: str, suffix: str) -> None:
    rows.sparkSession.dataSource.register(kind)
    rows.write.format(kind.name()).mode("append").option("path", path).option("suffix", suffix).save()


# Characters of a value that a folder name cannot hold, and the percent sign that marks them.
RESERVED = ("%", "/", "=")


def folder_name(value: Column) -> Column:
    for character in RESERVED:
        value = F.replace(value, F.lit(character), F.lit(f"%{ord(character):02X}"))
    return value


def plain_name(folder: Column) -> Column:
    for character in reversed(RESERVED):
        folder = F.replace(folder, F.lit(f"%{ord(character):02X}"), F.lit(character))
    return folder
