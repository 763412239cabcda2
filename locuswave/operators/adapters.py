"""Adapter removal from read pairs by the overlap of the mates.

Where the sequenced fragment is shorter than a read, the read runs on into the adapter.  Both mates then begin at the
fragment's ends, so the first read agrees with the reverse complement of the second over the whole fragment: the best
overlap gives the fragment's length and with it what to cut, without knowing the adapter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Public defaults of the overlap analysis.
MIN_OVERLAP, MAX_MISMATCHES, MAX_MISMATCH_SHARE = 30, 5, 0.20

COMPLEMENT = np.arange(256, dtype=np.uint8)
COMPLEMENT[list(b"ACGT")] = list(b"TGCA")

FOUND = T.StructType([T.StructField("insert_length", T.IntegerType()), T.StructField("mismatches", T.IntegerType())])


def candidates(n1: int, n2: int) -> list[tuple[int, int, int, int]]:
    """(overlap, length, start in read 1, start in the turned read 2) of every fragment length, longest overlap first."""
    out = []
    for length in range(MIN_OVERLAP, n1 + n2 - MIN_OVERLAP + 1):
        start = max(0, length - n2)
        overlap = min(n1, length) - start
        if overlap >= MIN_OVERLAP:
            out.append((overlap, length, start, start - (length - n2)))
    return sorted(out, key=lambda c: (-c[0], -c[1]))


def _letters(reads: list[str]) -> np.ndarray:
    """Reads of one length as a matrix of bytes."""
    joined = "".join(reads).upper().encode("ascii", "replace")
    return np.frombuffer(joined, np.uint8).reshape(len(reads), -1)


def inserts(first: list[str], second: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Fragment length and mismatches of pairs of equal read lengths; -1 where the mates do not overlap."""
    a, b = _letters(first), COMPLEMENT[_letters(second)[:, ::-1]]
    length, wrong = np.full(len(first), -1), np.full(len(first), -1)
    overlap_of = np.zeros(len(first), int)
    for overlap, size, at, turned in candidates(a.shape[1], b.shape[1]):
        # Open pairs, and those whose hit has the same overlap and may still have fewer mismatches here.
        open_ = np.flatnonzero((length < 0) | (overlap_of == overlap))
        if not len(open_):
            break
        differ = (a[open_, at:at + overlap] != b[open_, turned:turned + overlap]).sum(axis=1)
        better = (differ <= min(MAX_MISMATCHES, int(overlap * MAX_MISMATCH_SHARE))) & (
            (length[open_] < 0) | (differ < wrong[open_]))
        hit = open_[better]
        length[hit], wrong[hit], overlap_of[hit] = size, differ[better], overlap
    return length, wrong


@F.pandas_udf(FOUND)
def _overlap(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for first, second in pairs:
        length, wrong = np.full(len(first), -1), np.full(len(first), -1)
        # Reads of a run have few different lengths.
        for _, rows in first.groupby([first.str.len().fillna(-1), second.str.len().fillna(-1)]).indices.items():
            one, two = first.iloc[rows], second.iloc[rows]
            if one.iat[0] and two.iat[0]:
                length[rows], wrong[rows] = inserts(list(one), list(two))
        found = pd.DataFrame({"insert_length": length, "mismatches": wrong}).astype("Int32")
        found.loc[length < 0] = pd.NA
        yield found


def with_inserts(pairs: DataFrame) -> DataFrame:
    """Add ``insert_length`` and ``mismatches`` of the best overlap, NULL where the mates do not overlap.

    The best is the longest overlap within the mismatch bounds, of two equally long ones that with fewer mismatches,
    then the longer fragment.
    """
    found = pairs.withColumn("_o", _overlap(F.col("seq1"), F.col("seq2")))
    return found.select(*pairs.columns, "_o.insert_length", "_o.mismatches")


def trim(pairs: DataFrame) -> DataFrame:
    """Both mates cut to the fragment; ``trimmed_bases`` is what went, adapter and beyond."""
    known = with_inserts(pairs)
    keep = lambda m: F.least(F.length(f"seq{m}"), F.coalesce("insert_length", F.length(f"seq{m}")))
    gone = sum(F.coalesce(F.length(f"seq{m}") - keep(m), F.lit(0)) for m in (1, 2))
    cut = {f"{c}{m}": F.substring(F.col(f"{c}{m}"), F.lit(1), keep(m)) for c in ("seq", "qual") for m in (1, 2)}
    return known.select(*[cut[c].alias(c) if c in cut else c for c in pairs.columns], gone.alias("trimmed_bases"))
