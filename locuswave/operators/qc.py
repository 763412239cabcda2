"""Read and UMI quality filters and the per-sample metrics table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuswave.functions.dna import umi_passes
from locuswave.params import Params

# Columns of the metrics table, in published order.
METRICS = (
    "total_reads", "lowq_reads", "too_many_n_reads", "short_reads", "lowq_umis", "reads_passing_filter",
    "pct_reads_passing_filter", "pct_q30_reads_pf", "aligned_reads", "pct_aligned", "total_dedup_umis",
    "pct_duplication", "clipped_alignments", "low_mapq_alignments", "alignments_pf", "total_unique_sites",
)

# Public defaults of the read filter.
LOW_BASE_QUALITY, MAX_LOW_SHARE, MAX_N = 15, 0.40, 5


def umi_flags(pairs: DataFrame, params: Params, qual: str = "qual2") -> DataFrame:
    """Add ``umi_ok``, judged on the qualities of the first bases of the second read."""
    return pairs.withColumn("umi_ok", umi_passes(
        F.col(qual), params.umi_length, params.umi_base_qual_thresh, params.max_lowq_umi_bases))


def umi_report(flagged: DataFrame, keys: Sequence[str] = ("sample_id",)) -> DataFrame:
    counts = flagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_reads"), F.count_if("umi_ok").alias("passing_reads"),
        F.count_if(~F.col("umi_ok")).alias("failing_reads"))
    return counts.withColumn("passing_percentage", percent(F.col("passing_reads"), F.col("total_reads"), 0.0))


def percent(part: Column, whole: Column, when_empty: float | None = None) -> Column:
    return F.when(whole > 0, F.lit(100.0) * part / whole).otherwise(F.lit(when_empty).cast("double"))


def read_flags(pairs: DataFrame, params: Params, mates: Sequence[str] = ("1", "2")) -> DataFrame:
    """Add ``low_quality``, ``too_many_n``, ``too_short`` and ``read_ok`` for whole pairs.

    The rules apply in this order, a pair fails the first that one of its mates breaks.
    """
    def any_mate(rule) -> Column:
        columns = [rule(F.col(f"seq{m}"), F.col(f"qual{m}")) for m in mates]
        combined = columns[0]
        for column in columns[1:]:
            combined = combined | column
        return combined

    def low(seq: Column, qual: Column) -> Column:
        # Characters below the threshold, counted by removing them: stays in generated code.
        bad = F.length(qual) - F.length(F.regexp_replace(qual, f"[!-{chr(33 + LOW_BASE_QUALITY - 1)}]", ""))
        return bad > F.length(qual) * F.lit(MAX_LOW_SHARE)

    def many_n(seq: Column, qual: Column) -> Column:
        return F.length(seq) - F.length(F.replace(seq, F.lit("N"), F.lit(""))) > MAX_N

    def short(seq: Column, qual: Column) -> Column:
        return F.length(seq) < params.umi_length

    return (
        pairs.withColumn("low_quality", any_mate(low))
        .withColumn("too_many_n", ~F.col("low_quality") & any_mate(many_n))
        .withColumn("too_short", ~F.col("low_quality") & ~F.col("too_many_n") & any_mate(short))
        .withColumn("read_ok", ~(F.col("low_quality") | F.col("too_many_n") | F.col("too_short")))
    )


def read_report(flagged: DataFrame, keys: Sequence[str] = ("sample_id",), mates: Sequence[str] = ("1", "2")) -> DataFrame:
    """Pairs per outcome and the share of bases at quality 30 or better before filtering."""
    bases = sum((F.length(f"qual{m}") for m in mates), F.lit(0))
    q30 = sum((F.length(F.regexp_replace(f"qual{m}", "[!->]", "")) for m in mates), F.lit(0))
    counts = flagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_reads"), F.count_if("low_quality").alias("lowq_reads"),
        F.count_if("too_many_n").alias("too_many_n_reads"), F.count_if("too_short").alias("short_reads"),
        F.count_if("read_ok").alias("reads_passing_filter"),
        F.sum(q30).alias("_q30"), F.sum(bases).alias("_bases"))
    return counts.withColumn("pct_q30_reads_pf", percent(F.col("_q30"), F.col("_bases"))).drop("_q30", "_bases")


def extract_umi(pairs: DataFrame, params: Params) -> DataFrame:
    """UMI from the head of the second read into its own column; only the first read goes on."""
    return pairs.select(
        *[c for c in pairs.columns if c not in ("seq2", "qual2", "umi_ok")],
        F.substring("seq2", 1, params.umi_length).alias("umi"))


def qc_metrics(samples: DataFrame, reads: DataFrame, umis: DataFrame | None, aligned: DataFrame,
               dedup: DataFrame | None, counted: DataFrame) -> DataFrame:
    """One row per sample: identifier, sample group, replicate, concentration and the metrics.

    All inputs are per-sample aggregates keyed by ``sample_id``.
    """
    rows = samples.join(reads, "sample_id")
    if umis is not None:
        # Reads that passed both filters replace those that passed the first.
        rows = rows.drop("reads_passing_filter").join(umis.select(
            "sample_id", F.col("failing_reads").alias("lowq_umis"),
            F.col("passing_reads").alias("reads_passing_filter")), "sample_id")
    else:
        rows = rows.withColumn("lowq_umis", F.lit(None).cast("long"))
    rows = rows.join(aligned.select("sample_id", "input_reads", "aligned_reads"), "sample_id")
    if dedup is not None:
        rows = rows.join(dedup.select("sample_id", "total_dedup_umis", "pct_duplication"), "sample_id")
    else:
        rows = rows.withColumn("total_dedup_umis", F.lit(None).cast("long")).withColumn(
            "pct_duplication", F.lit(None).cast("double"))
    rows = rows.join(counted.select(
        "sample_id", F.col("above_clipping").alias("clipped_alignments"),
        F.col("low_mapping_quality").alias("low_mapq_alignments"),
        F.col("passing_reads").alias("alignments_pf"), F.col("total_sites").alias("total_unique_sites")), "sample_id")
    return rows.withColumn(
        "pct_reads_passing_filter", percent(F.col("reads_passing_filter"), F.col("total_reads")),
    ).withColumn("pct_aligned", percent(F.col("aligned_reads"), F.col("input_reads"))).select(
        F.col("sample_id").alias("identifier"), "sample_group", "replicate", "concentration", *METRICS)
