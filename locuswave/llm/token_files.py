"""Token-id files: documents in ascending id order, coded by the adaptive range coder, read back by document.

The file table has a row per stripe: the task that wrote it, the number of ids of that task ahead of it, and
``data``, which is self-contained: an index of its documents and the coded ids.  Stripes end with a document, hold
about ``STRIPE`` ids and carry checksums for the index, the header and every block.

Documents are dealt out by ranges of their id; where a stripe begins among all ids follows from one sum per task.

Defined cases: a NULL text is empty; every document ends with the id ``END``.  NULL ids come first, rows that repeat
an id are ordered by the hash of their text, then by the text.  Other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locuswave.llm import range_coder
from locuswave.llm.common import table
from locuswave.session import bounded_side, stage

END = 2
TOKENIZER = "word_bpe_49k.json"
STRIPE = 4_000_000
# Sums per task (12 bytes each) up to this number are broadcast.
BROADCAST_TASKS = 1_000_000


def pack_stripe(doc_ids: list[int | None], texts: list[np.ndarray]) -> bytes:
    sizes = np.array([len(t) for t in texts], "<i8")
    null = np.array([d is None for d in doc_ids], np.uint8)
    index = zlib.compress(np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes() + sizes.tobytes()
                          + null.tobytes(), 1)
    return struct.pack("<III", len(texts), len(index), zlib.crc32(index)) + index + range_coder.encode(
        np.concatenate(texts))


def unpack_stripe(data: bytes) -> tuple[list[int | None], list[np.ndarray]]:
    count, size, crc = struct.unpack_from("<III", data)
    index = data[12:12 + size]
    if zlib.crc32(index) != crc:
        raise ValueError("damaged stripe index")
    index = zlib.decompress(index)
    ids, sizes = np.frombuffer(index, "<i8", count), np.frombuffer(index, "<i8", count, 8 * count)
    null = np.frombuffer(index, np.uint8, count, 16 * count)
    parts = np.split(range_coder.decode(data[12 + size:]), np.cumsum(sizes)[:-1])
    return [None if n else int(d) for d, n in zip(ids, null)], parts


def _write(tokenizer: str, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    from locuswave.llm.tokens import piece_tokenizer, slices

    part, source, written = TaskContext.get().partitionId(), piece_tokenizer(tokenizer, False), 0
    end, docs, texts, held = np.array([END], np.uint32), [], [], 0

    def row() -> pd.DataFrame:
        return pd.DataFrame({"part": [part], "ahead": [written], "n_ids": [held], "data": [pack_stripe(docs, texts)]})

    for frame in frames:
        for begin, stop in slices(frame["text"]):
            some = frame.iloc[begin:stop]
            for doc_id, ids in zip(some["doc_id"], source.ids(list(some["text"]))):
                docs.append(None if pd.isna(doc_id) else int(doc_id))
                texts.append(np.append(ids, end))
                held += len(ids) + 1
                if held >= STRIPE:
                    yield row()
                    written, held, docs, texts = written + held, 0, [], []
    if texts:
        yield row()


def write(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Writes the stripes of ``docs`` to the shared folder; the table read from there."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_h"))
    rows = rows.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text")
    return stage(rows.select("doc_id", "text").mapInPandas(
        lambda frames: _write(tokenizer, frames), "part int, ahead long, n_ids long, data binary"), "token-files")


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for begin, data in zip(frame["begin"], frame["data"]):
            docs, texts = unpack_stripe(data)
            sizes = np.array([len(t) for t in texts], np.int64)
            yield pd.DataFrame({
                "doc_id": pd.array(docs, "Int64"), "start": begin + np.cumsum(sizes) - sizes, "n_tokens": sizes,
                "ids": [t.astype("<u4").tobytes() for t in texts]})


def read(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents ahead), n_tokens, ids (little-endian unsigned 32 bit) of each document."""
    per_task = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = stage(per_task.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")), "task-starts")
    placed = files.join(bounded_side(first, BROADCAST_TASKS), "part")
    return placed.select((F.col("first") + F.col("ahead")).alias("begin"), "data").mapInPandas(
        _read, "doc_id long, start long, n_tokens long, ids binary")


def op6_mixed_range_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read(write(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
