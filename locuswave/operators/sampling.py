"""Reproducible subsampling to a number of reads per sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locuswave.session import bounded_side, stage


def thresholds(reads: DataFrame, target: int, seed: int = 100, sample: str = "sample_id", read: str = "read_id") -> DataFrame:
    """(sample, _h, _read): hash and id of the ``target``-th read by hash; samples with fewer reads have no row.

    Reads two columns.  Hashes are counted in 65,536 buckets, map-side first; the one bucket per sample in which the
    target is reached is then ordered, a 65,536th of the sample's reads.
    """
    keyed = reads.select(F.col(sample), F.col(read).cast("string").alias("_read"), digest(read, seed).alias("_h"))
    keyed = keyed.withColumn("_b", F.substring("_h", 1, 4))
    sizes = keyed.groupBy(sample, "_b").agg(F.count(F.lit(1)).alias("_k"))
    upto = Window.partitionBy(sample).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = sizes.withColumn("_upto", F.sum("_k").over(upto))
    edge = stage(sizes.filter((F.col("_upto") >= target) & (F.col("_upto") - F.col("_k") < target)).select(
        sample, "_b", (F.lit(target) - F.col("_upto") + F.col("_k")).alias("_rest")), "sample-edges")
    order = Window.partitionBy(sample, "_b").orderBy("_h", "_read")
    inside = keyed.join(bounded_side(edge), [sample, "_b"]).withColumn("_n", F.row_number().over(order))
    return inside.filter(F.col("_n") == F.col("_rest")).select(sample, "_h", "_read")


def digest(read: str, seed: int):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(read).cast("string")))


def subsample(reads: DataFrame, target: int, seed: int = 100, sample: str = "sample_id",
              read: str = "read_id") -> DataFrame:
    """The ``target`` reads of every sample with the smallest seeded hash.

    Whole rows are read once and filtered by their sample's threshold; no row is shuffled or sorted.  Rows that share
    a read id stay together.
    """
    edge = bounded_side(stage(thresholds(reads, target, seed, sample, read), "sample-thresholds"))
    marked = reads.withColumn("_mine", F.struct(digest(read, seed).alias("h"), F.col(read).cast("string").alias("r"))).join(
        edge, sample, "left")
    return marked.filter(F.col("_h").isNull() | (F.col("_mine") <= F.struct(F.col("_h").alias("h"), F.col("_read").alias("r")))).select(
        *reads.columns)
