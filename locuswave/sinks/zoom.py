"""Zoom levels of a track: per bin the least, greatest and summed value and the covered bases.

The finest level is made from the runs, every further one from the level before, ``FACTOR`` bins to one, until a bin
holds each contig.  The table is sorted by coordinate and has a range index, so that a viewer reads the one level whose
bins suit its region, and of that only the files that overlap.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuswave.session import stage
from locuswave.sources.ranges import files_of, write_ranges

BASE, FACTOR = 256, 4
KEYS = ("grp", "rep", "chrom")
INDEXED = ("level", *KEYS)


def finest(rows: DataFrame, width: int = BASE) -> DataFrame:
    """Bins of ``width`` bases of bedGraph rows (grp, rep, chrom, start, stop, value); runs do not overlap."""
    pieces = rows.withColumn("bin", F.explode(F.sequence(F.expr(f"start div {width}"), F.expr(f"(stop - 1) div {width}"))))
    bases = F.least(F.col("stop"), (F.col("bin") + 1) * width) - F.greatest(F.col("start"), F.col("bin") * width)
    return pieces.groupBy(*KEYS, "bin").agg(
        F.min("value").alias("least"), F.max("value").alias("greatest"),
        F.sum(F.col("value") * bases).alias("total"), F.sum(bases).alias("covered"))


def coarser(level: DataFrame, factor: int = FACTOR) -> DataFrame:
    return level.groupBy(*KEYS, F.expr(f"bin div {factor}").alias("bin")).agg(
        F.min("least").alias("least"), F.max("greatest").alias("greatest"), F.sum("total").alias("total"),
        F.sum("covered").alias("covered"))


def pyramid(rows: DataFrame, base: int = BASE, factor: int = FACTOR) -> DataFrame:
    """(level, grp, rep, chrom, start, stop, least, greatest, total, covered) of all levels, 0 the finest.

    The number of levels grows with the logarithm of the longest contig.
    """
    level, width, now, out = 0, base, stage(finest(rows, base), "zoom"), None
    while True:
        shown = now.select(
            F.lit(level).alias("level"), *KEYS, (F.col("bin") * width).alias("start"), ((F.col("bin") + 1) * width).alias("stop"),
            "least", "greatest", "total", "covered")
        out = shown if out is None else out.unionByName(shown)
        if not (now.agg(F.max("bin")).first()[0] or 0):
            return out
        level, width, now = level + 1, width * factor, stage(coarser(now, factor), "zoom")


def write_zoom(rows: DataFrame, path: str, base: int = BASE, factor: int = FACTOR, parts: int | None = None) -> None:
    """All levels as Parquet, a folder per level, with a range index of the files."""
    keys = [*INDEXED, "start"]
    levels = pyramid(rows, base, factor)
    dealt = levels.repartitionByRange(parts, *keys) if parts else levels.repartitionByRange(*keys)
    dealt.sortWithinPartitions(*keys).write.partitionBy("level").parquet(path)
    write_ranges(rows.sparkSession, path, INDEXED)


def read_zoom(spark: SparkSession, path: str, chrom: str, start: int, stop: int, bins: int = 1000, base: int = BASE,
              factor: int = FACTOR) -> DataFrame:
    """Summaries of ``[start, stop)`` at the finest level with at most ``bins`` bins there, or the coarsest."""
    level, width = 0, base
    coarsest = spark.read.parquet(path).agg(F.max("level")).first()[0] or 0
    while level < coarsest and (stop - 1) // width - start // width + 1 > bins:
        level, width = level + 1, width * factor
    files = [r.file for r in files_of(spark, path, chrom, start, stop, level=str(level)).select("file").distinct().collect()]
    layout = spark.read.parquet(path).schema
    if not files:
        return spark.createDataFrame([], layout)
    rows = spark.read.schema(layout).option("basePath", path).parquet(*[os.path.join(path, f) for f in files])
    return rows.filter((F.col("level") == level) & (F.col("chrom") == chrom) & (F.col("start") < stop) & (F.col("stop") > start))
