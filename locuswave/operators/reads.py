"""From alignments to per-position read-start counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuswave.functions import cigar as cg
from locuswave.params import Params
from locuswave.schema import EXACT, value_names
from locuswave.session import bounded_side, stage


def classify(alignments: DataFrame, params: Params) -> DataFrame:
    """Primary mapped alignments with the three independent failure flags and the read start."""
    placed = alignments.filter(
        F.col("chrom").isNotNull() & (F.col("pos") >= 0) & cg.is_primary(F.col("flag"))
    )
    return (
        placed.withColumn("ref_length", cg.reference_length(F.col("cigar")))
        .withColumn("low_mapq", F.col("mapq") < params.min_map_qual)
        .withColumn("over_clip", cg.five_prime_clip(F.col("cigar"), F.col("flag")) > params.max_clipping)
        .withColumn("short", F.col("ref_length") < params.min_aln_length)
        .withColumn("start", cg.read_start(F.col("pos"), F.col("flag"), F.col("ref_length")))
        .withColumn("passing", ~(F.col("low_mapq") | F.col("over_clip") | F.col("short")))
    )


def read_start_counts(classified: DataFrame) -> DataFrame:
    """Passing reads per ``(sample_id, chrom, pos)``; combined map-side, so hot positions are safe."""
    return (
        classified.filter("passing")
        .groupBy("sample_id", "chrom", F.col("start").alias("pos"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def count_stats(classified: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Per sample: total, passing and failing reads and the number of distinct start sites."""
    flags = classified.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("total_reads"),
        F.count_if("passing").alias("passing_reads"),
        F.count_if("low_mapq").alias("low_mapping_quality"),
        F.count_if("over_clip").alias("above_clipping"),
        F.count_if("short").alias("below_ref_length"),
    )
    counts = read_start_counts(classified) if counts is None else counts
    sites = counts.groupBy("sample_id").agg(F.count(F.lit(1)).alias("total_sites"))
    return (
        flags.join(sites, "sample_id", "left")
        .withColumn("total_sites", F.coalesce("total_sites", F.lit(0).cast("long")))
    )


def per_million(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Counts per million primary reads, as exact ten-decimal numbers.

    ``totals`` has one row per sample: it is computed once, and broadcast behind a size check.
    """
    side = bounded_side(stage(totals.select("sample_id", "total_reads"), "read-totals"))
    scaled = F.round(F.col("n") / (F.col("total_reads") / F.lit(1e6)), 10).cast(EXACT)
    return counts.join(side, "sample_id").withColumn("n", scaled).drop("total_reads")


def merge_replicates(counts: DataFrame, reps: Sequence[int], keys: Sequence[str] = ("grp", "chrom", "pos"),
                     rep: str = "rep", value: str = "n") -> DataFrame:
    """All replicates of a group side by side, missing positions as zero.

    One aggregation with a fixed replicate list instead of a chain of outer joins.
    """
    zero = F.lit(0).cast(counts.schema[value].dataType)
    columns = [
        F.sum(F.when(F.col(rep) == r, F.col(value)).otherwise(zero)).cast(counts.schema[value].dataType).alias(name)
        for r, name in zip(reps, value_names(len(reps)))
    ]
    return counts.groupBy(*keys).agg(*columns)
