"""Packing token sequences by best fit, decreasing.

Overlong documents are first cut into full windows; what remains of each is packed.  Pieces of one length are
alike, so best-fit decreasing runs over the histogram of lengths, which has at most ``WINDOW`` rows: a segment tree
over remaining capacities finds the tightest open windows, and all of them with that capacity are filled at once.
The result, the same as placing piece after piece, is a short table of segments; every piece finds its place by its
rank among the pieces of its length.  Ranks are counted where the pieces are made and shifted by one sum per task
and length, so no group of pieces is ever gathered.

Defined cases: a NULL text is empty; every document ends with the id ``END``, so each has at least one piece.  Equal
documents, repeated and NULL ids are packed like any others.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locuswave.llm.common import table
from locuswave.session import bounded_side, stage

WINDOW = 1024
END = 0
TOKENIZER = "byte_bpe_50k.json"
# First ranks per task and length (28 bytes each) are broadcast up to this number and shuffled beyond it.
BROADCAST_RANKS = 2_000_000


class CapacityTree:
    """Segment tree over remaining capacities: open windows of each, and the smallest capacity that fits."""

    def __init__(self, window: int) -> None:
        self.size = 1 << window.bit_length()
        self.open = [0] * (2 * self.size)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(self.size)]

    def push(self, capacity: int, first: int, count: int) -> None:
        if count and capacity:
            self.ranges[capacity].append((first, count))
            self._add(capacity, count)

    def pop(self, capacity: int) -> tuple[int, int]:
        first, count = self.ranges[capacity].pop()
        self._add(capacity, -count)
        return first, count

    def _add(self, capacity: int, count: int) -> None:
        at = capacity + self.size
        while at:
            self.open[at] += count
            at >>= 1

    def tightest(self, length: int) -> int | None:
        """Smallest capacity of at least ``length`` that an open window has."""
        at = length + self.size
        if self.open[at]:
            return length
        while at > 1:
            if not at & 1 and self.open[at + 1]:  # the nearest subtree to the right that holds a window
                at += 1
                while at < self.size:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return None


def best_fit_decreasing(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Segments (length, rank_from, rank_to, sequence_from, per_sequence, base) from the number of pieces per length.

    Piece number r of a length, in the segment with rank_from <= r < rank_to, lies in sequence
    sequence_from + (r - rank_from) // per_sequence at base + (r - rank_from) % per_sequence * length.
    """
    tree, segments, used = CapacityTree(window), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, first, count = window, used, -(-left // (window // length))
                used += count
            else:
                first, count = tree.pop(capacity)
            # A window that took a piece is the tightest for the next one while that fits.
            each = capacity // length
            full = min(count, left // each)
            base = window - capacity
            if full:
                segments.append((length, rank, rank + full * each, first, each, base))
                rank, left = rank + full * each, left - full * each
                tree.push(capacity - each * length, first, full)
            if full < count and left:  # fewer pieces than a window takes
                segments.append((length, rank, rank + left, first + full, left, base))
                tree.push(capacity - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            tree.push(capacity, first + full, count - full)
    return segments


def _cut(tokenizer: str, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    from locuswave.llm.tokens import piece_tokenizer, slices

    part, seen = TaskContext.get().partitionId(), np.zeros(WINDOW + 1, np.int64)
    source = piece_tokenizer(tokenizer, True)
    end = np.array([END], "<u4")
    for frame in frames:
        for begin, stop in slices(frame["text"]):
            some = frame.iloc[begin:stop]
            rows = []
            for doc_id, ids in zip(some["doc_id"], source.ids(list(some["text"]))):
                ids = np.concatenate([ids, end]).astype("<u4")
                for start in range(0, len(ids), WINDOW):
                    piece = ids[start:start + WINDOW]
                    rows.append((part, doc_id, start, len(piece), len(ids), seen[len(piece)], piece.tobytes()))
                    seen[len(piece)] += 1
            out = pd.DataFrame(rows, columns=["part", "doc_id", "start", "length", "doc_tokens", "local_rank", "ids"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """The documents' windows and remainders with their ids, and their rank per task and length."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        lambda frames: _cut(tokenizer, frames),
        "part int, doc_id long, start long, length int, doc_tokens long, local_rank long, ids binary")


def pack(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids (little-endian unsigned 32 bit), sequence_id, offset per piece."""
    made = stage(pieces(docs, tokenizer), "pieces")
    per_task = stage(made.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = stage(per_task.select(
        "part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first_rank")), "first-ranks")
    plan = docs.sparkSession.createDataFrame(
        best_fit_decreasing(counts),
        "plan_length int, rank_from long, rank_to long, sequence_from long, per_sequence long, base long")
    ranked = made.join(bounded_side(first, BROADCAST_RANKS), ["part", "length"]).withColumn(
        "rank", F.col("first_rank") + F.col("local_rank"))
    # The plan's size depends on the window only.
    placed = ranked.join(F.broadcast(plan), (F.col("length") == F.col("plan_length"))
                         & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")))
    within = F.col("rank") - F.col("rank_from")
    return placed.select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "doc_tokens", "ids",
        (F.col("sequence_from") + F.floor(within / F.col("per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("base") + within % F.col("per_sequence") * F.col("length")).cast("long").alias("offset"))


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(table(spark, sf_dir, "documents")))
