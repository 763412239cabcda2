"""From peaks to reported and called sites."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuswave.functions.coords import on_target
from locuswave.operators.intervals import lookup
from locuswave.operators.nulls import with_p_value
from locuswave.operators.ranking import ordinal, rank_from_zero_if
from locuswave.params import Params
from locuswave.schema import mean_of, total_of, value_names
from locuswave.session import fits_broadcast, stage


@dataclass(frozen=True)
class Evidence:
    """Signal tables and nulls a site is judged by; ``grp`` of the control tables is the control id.

    ``n`` counts the test replicates, ``m`` those of the control (two when the test has one).
    """

    test_sums: DataFrame
    control_sums: DataFrame
    wide_sums: DataFrame
    peak_null: DataFrame
    wide_null: DataFrame
    n: int
    m: int


def judge(points: DataFrame, evidence: Evidence, params: Params, early: bool,
          keys: tuple[str, ...] = ("grp", "chrom", "pos")) -> DataFrame:
    """Window values, p-values and flags of ``(grp, control_grp, chrom, pos, v1..vn)``.

    With ``early``, weak peaks leave before the costly lookups; without, every point is kept.
    """
    n, m = evidence.n, evidence.m
    if early:
        points = points.filter(total_of(n) >= params.min_peak_signal)
    tested = with_p_value(points, evidence.peak_null, mean_of(n), "control_grp", "test_pval")
    if early:
        tested = tested.filter(F.col("test_pval") <= params.test_pval_reporting_thresh)
    tested = stage(tested, "weighed")
    small = fits_broadcast(tested)

    def add(rows: DataFrame, runs: DataFrame, width: int, prefix: str, grp: str) -> DataFrame:
        return lookup(rows, runs, width, prefix, grp=grp, keys=keys, bucket=params.lookup_bucket, small=small)

    noisy = add(tested, evidence.wide_sums, m, "w", "control_grp")
    noisy = with_p_value(noisy, evidence.wide_null, mean_of(m, "w"), "control_grp", "background_pval")
    if early and not params.include_noise_pval_fails:
        noisy = noisy.filter(F.col("background_pval") >= params.ctrl_noise_pval_calling_thresh)
    noisy = stage(noisy, "judged")
    full = add(noisy, evidence.test_sums, n, "t", "grp")
    full = add(full, evidence.control_sums, m, "c", "control_grp")
    return full.select(
        "*",
        (F.col("test_pval") <= params.test_pval_calling_thresh).alias("digested"),
        (F.col("background_pval") <= params.ctrl_noise_pval_calling_thresh).alias("high_background"),
    ).withColumn("site_called", F.col("digested") & ~F.col("high_background"))


def mark_on_target(sites: DataFrame, params: Params) -> DataFrame:
    """``is_on_target`` from ``motif_location`` and ``on_target_location`` of the sample sheet."""
    hit = on_target(F.col("motif_location"), F.col("on_target_location"), params.on_target_overlap)
    return sites.withColumn("is_on_target", F.coalesce(hit, F.lit(False)))


def finish_sites(sites: DataFrame, n: int, m: int, params: Params) -> DataFrame:
    """Rank, share of the highest called signal and the derived totals of reported sites."""
    names = value_names(n)
    sites = sites.withColumn("mean_signal", mean_of(n))
    ordered = ordinal(
        sites, ["grp"],
        [F.desc("is_on_target"), F.desc("site_called"), F.desc("mean_signal"), F.asc("chrom"), F.asc("pos")],
    )
    ranked = rank_from_zero_if(ordered, ["grp"], "is_on_target", "ordinal", "rank")
    # One row per group of the sample sheet.
    best = ranked.filter("site_called").groupBy("grp").agg(*[F.max(c).alias(f"_m{c}") for c in names])
    shared = ranked.join(F.broadcast(best), "grp", "left")
    shares = [
        F.when(F.col(f"_m{c}") > 0, F.lit(100.0) * F.col(c) / F.col(f"_m{c}")).cast("double").alias(f"pct{k}")
        for k, c in enumerate(names, 1)
    ]
    return with_totals(shared.select(*ranked.columns, *shares), n, m, params)


def with_totals(sites: DataFrame, n: int, m: int, params: Params) -> DataFrame:
    wide = "c" if params.compat_wide_totals else "w"
    pct = [F.col(c) for c in value_names(n, "pct")]
    mean_pct = sum(pct[1:], pct[0]) / F.lit(n)
    return sites.select(
        "*", (F.col("pos") + 1).alias("position_1b"),
        total_of(n).alias("total_signal"),
        total_of(n, "t").alias("total_test_reads"), total_of(m, "c").alias("total_control_reads"),
        total_of(m, wide).alias("total_wide_control_reads"),
        mean_of(m, wide).alias("mean_wide_control_reads"),
        mean_pct.alias("mean_pct_max_peak"),
    )
