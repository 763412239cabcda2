"""Region scans of written signal tables through a side table of the coordinate range of every file.

``sinks.write_signal`` leaves, below ``_ranges`` in the table's folder, one row per file, group and contig with the
smallest start and the greatest stop.  A region scan asks this table first and opens only the files that can hold
overlapping runs; row-group statistics then prune inside them.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locuswave.operators.intervals import region

INDEX = "_ranges"


def write_ranges(spark: SparkSession, path: str, keys: Sequence[str] = ("grp", "chrom")) -> None:
    """Index of the written table at ``path`` by its key columns; reads these and the coordinates."""
    table = spark.read.parquet(path).select(
        *[F.col(k).cast("string").alias(k) for k in keys], "start", "stop",
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    found = table.groupBy("file", "bytes", *keys).agg(
        F.min("start").alias("first"), F.max("stop").alias("last"), F.count(F.lit(1)).alias("rows"))
    # File names relative to the table, so that it may be moved.
    below = F.substring_index("file", f"/{os.path.basename(path.rstrip('/'))}/", -1)
    found.select(below.alias("file"), "bytes", *keys, "first", "last", "rows").write.parquet(os.path.join(path, INDEX))


def files_of(spark: SparkSession, path: str, chrom: str, start: int | None = None, stop: int | None = None,
             **keys: str | None) -> DataFrame:
    """Index rows of the files that can hold rows of the region, and of the given values of other keys."""
    index = spark.read.parquet(os.path.join(path, INDEX)).filter(F.col("chrom") == chrom)
    for name, value in keys.items():
        if value is not None:
            index = index.filter(F.col(name) == value)
    if stop is not None:
        index = index.filter(F.col("first") < stop)
    if start is not None:
        index = index.filter(F.col("last") > start)
    return index


def read_region(spark: SparkSession, path: str, chrom: str, start: int | None = None, stop: int | None = None,
                grp: str | None = None) -> DataFrame:
    """Runs of the written table that overlap ``[start, stop)``; an unknown contig or group gives no rows."""
    # As many names as files overlap the region.
    files = [r.file for r in files_of(spark, path, chrom, start, stop, grp=grp).select("file").distinct().collect()]
    # Folder names look like numbers to Spark where all groups do; a group is always text.
    layout = T.StructType([
        T.StructField(f.name, T.StringType()) if f.name == "grp" else f for f in spark.read.parquet(path).schema])
    if not files:
        return spark.createDataFrame([], layout)
    runs = spark.read.schema(layout).option("basePath", path).parquet(*[os.path.join(path, f) for f in files])
    if grp is not None:
        runs = runs.filter(F.col("grp") == grp)
    return region(runs, chrom, start, stop)
