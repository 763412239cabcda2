"""Text files with line numbers, read in parallel splits.

A split knows where it begins in its file; counting the lines of all splits once gives the number
of the first line of each, without gathering a file in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locuswave.files import listed, plain_path
from locuswave.session import bounded_side, stage
from locuswave.sources.bgzf import SPLIT_BYTES, SUFFIXES, compressed_lines


def split_lines(spark: SparkSession, paths: Sequence[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Rows ``(path, split, _id, line)``; ``_id`` grows by one from line to line inside a split.

    Blocked gzip files (``.gz``, ``.bgz``, ``.bgzf``) and plain files are cut at the split size; an ordinary
    gzip file is one split.
    """
    # As many files as the caller names, in folders or not.
    files = [(r.path, r.length) for r in listed(spark, paths).collect()]
    packed = [f for f in files if f[0].endswith(SUFFIXES)]
    plain = [path for path, _ in files if not path.endswith(SUFFIXES)]
    parts = []
    if packed or not plain:
        parts.append(compressed_lines(spark, packed, split_bytes).select(
            "path", "split", F.col("line_in_split").alias("_id"), "line"))
    if plain:
        parts.append(spark.read.text(plain).select(
            plain_path(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("_id"), F.col("value").alias("line")))
    return reduce(DataFrame.unionByName, parts)


def numbered_lines(spark: SparkSession, paths: Sequence[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Rows ``(path, split, line_no, line)``; ``line_no`` counts from 0 in every file."""
    # Written once: how plain files are cut into splits may differ from one scan to the next.
    lines = stage(split_lines(spark, paths, split_bytes), "lines")
    sizes = lines.groupBy("path", "split").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    earlier = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "path", "split", "_first", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before"))
    side = bounded_side(stage(offsets, "line-offsets"))
    return lines.join(side, ["path", "split"]).select(
        "path", "split", (F.col("_before") + F.col("_id") - F.col("_first")).alias("line_no"), "line")
