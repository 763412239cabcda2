"""The analysis from counts to consensus sites, as one chain of table-to-table steps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuswave.operators import aggregate, calling, motif, nulls, peaks, signal
from locuswave.params import Params
from locuswave.session import stage, together


@dataclass(frozen=True)
class SignalTables:
    test_sums: DataFrame
    control_sums: DataFrame
    wide_sums: DataFrame
    diffs: DataFrame
    test_peaks: DataFrame
    control_peaks: DataFrame
    test_peak_hist: DataFrame
    control_peak_hist: DataFrame
    wide_hist: DataFrame

    def evidence(self, n: int, m: int, params: Params) -> calling.Evidence:
        overwrite = params.compat_histogram_overwrite
        made = together(
            peak=lambda: stage(nulls.null_from_histogram(self.control_peak_hist, overwrite=overwrite), "peak-null"),
            wide=lambda: stage(nulls.null_from_histogram(self.wide_hist, overwrite=overwrite), "wide-null"),
        )
        return calling.Evidence(
            self.test_sums, self.control_sums, self.wide_sums, made["peak"], made["wide"], n, m)


def signal_tables(counts: DataFrame, groups: DataFrame, n: int, m: int, params: Params,
                  contigs: DataFrame | None = None) -> SignalTables:
    """All signal tables of a run.

    ``counts`` holds test and control groups side by side; ``groups`` pairs them.  What several
    later steps read is written once in the shared folder; independent tables are made together.
    """
    counts = stage(counts, "counts")
    controls = groups.select(F.col("control_grp").alias("grp")).distinct()
    control = counts.join(F.broadcast(controls), "grp", "left_semi")
    test = counts.join(F.broadcast(groups.select("grp")), "grp", "left_semi")
    w, gap, tile = params.stat_window, params.peak_window, params.tile

    def difference() -> tuple[DataFrame, DataFrame]:
        diffs = signal.window_diffs(test, signal.fan_out_control(control, groups), n, w, tile, contigs)
        return diffs, stage(peaks.signal_peaks(diffs, n, gap, tile), "peaks")

    def null_peaks() -> DataFrame:
        null = signal.self_diffs(control, m, w, tile, contigs)
        return stage(peaks.signal_peaks(null, m, gap, tile), "control-peaks")

    made = together(
        difference=difference, null_peaks=null_peaks,
        test=lambda: signal.window_sums(test, n, w, tile, contigs),
        control=lambda: signal.window_sums(control, m, w, tile, contigs),
        wide=lambda: signal.window_sums(control, m, params.control_noise_window, tile, contigs),
    )
    diffs, test_peaks = made["difference"]
    return SignalTables(
        test_sums=made["test"], control_sums=made["control"], wide_sums=made["wide"], diffs=diffs,
        test_peaks=test_peaks, control_peaks=made["null_peaks"],
        test_peak_hist=peaks.peak_histogram(test_peaks, n),
        control_peak_hist=peaks.peak_histogram(made["null_peaks"], m),
        wide_hist=signal.value_histogram(made["wide"], m),
    )


def reported_sites(tables: SignalTables, groups: DataFrame, evidence: calling.Evidence, params: Params,
                   genome: DataFrame | None = None, chunk: int = 0) -> DataFrame:
    """Ranked reported sites of all test groups.

    ``groups``: ``sample_group, conc, grp, control_grp`` and, with a genome, the on-target columns.
    """
    points = tables.test_peaks.join(F.broadcast(groups), "grp")
    sites = calling.judge(points, evidence, params, early=True)
    if genome is not None:
        # Each site is searched as far as its own motif asks for.
        half = F.floor(F.length("on_target_motif") * F.lit(params.motif_search_factor))
        sites = motif.site_windows(sites, genome, half, chunk)
        sites = calling.mark_on_target(motif.find_motif(sites, params), params).drop("window", "window_start")
    else:
        sites = without_motif(sites)
    # Ranking reads its rows twice, once for the ranges: the windows and the motif are made once.
    return calling.finish_sites(stage(sites, "judged"), evidence.n, evidence.m, params)


def without_motif(sites: DataFrame) -> DataFrame:
    return sites.select(
        "*", F.lit(False).alias("is_on_target"),
        *[F.lit(None).cast("string").alias(c) for c in ("motif_location", "closest_motif")],
        *[F.lit(None).cast("int").alias(c) for c in ("motif_score", "num_subs", "num_gaps")])


def consensus_sites(reported: DataFrame, groups: DataFrame, tables: SignalTables, evidence: calling.Evidence,
                    params: Params) -> DataFrame:
    """Ranked consensus sites of all sample groups, one row per site with its sites per concentration."""
    grid = stage(aggregate.complete_grid(reported, groups, tables.diffs, evidence, params), "grid")
    best = aggregate.consensus(aggregate.site_tuples(grid, evidence.n), params)
    return aggregate.rank_consensus(best)
