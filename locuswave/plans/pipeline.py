"""Whole runs: reads to alignment input, and alignments to site lists and reports.

The short-read aligner itself is an outside tool; its output (SAM text or a table in the same
layout) is the input of ``analyse``.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuswave.functions import cigar as cg
from locuswave.operators import adapters, aggregate, dedup, groups, qc, reads, sampling
from locuswave.operators.calling import Evidence
from locuswave.params import Params
from locuswave.plans import calls, report
from locuswave.session import stage
from locuswave.sinks import files, tracks
from locuswave.sinks import tables as sink


@dataclass(frozen=True)
class Preprocessed:
    reads: DataFrame
    read_report: DataFrame
    umi_report: DataFrame | None


def preprocess(pairs: DataFrame, params: Params) -> Preprocessed:
    """Subsample, cut adapters, drop poor reads and poor UMIs, move the UMI off the second read."""
    if params.subsample_fastqs:
        pairs = sampling.subsample(pairs, params.subsample_target_reads, params.subsample_seed)
    if params.trim_adapters and "seq2" in pairs.columns:
        pairs = adapters.trim(pairs)
    mates = ("1", "2") if params.use_umis else ("1",)
    flagged = qc.read_flags(pairs, params, mates)
    if params.use_umis:
        flagged = qc.umi_flags(flagged, params)
    flagged = stage(flagged, "flagged-reads")
    kept = flagged.filter("read_ok").drop("low_quality", "too_many_n", "too_short", "read_ok")
    if not params.use_umis:
        return Preprocessed(kept.drop("seq2", "qual2"), qc.read_report(flagged, mates=mates), None)
    umis = qc.umi_report(flagged.filter("read_ok"))
    return Preprocessed(qc.extract_umi(kept.filter("umi_ok"), params), qc.read_report(flagged, mates=mates), umis)


@dataclass(frozen=True)
class Analysis:
    """Results of the replicate groups that share a number of test and control replicates."""

    n: int
    m: int
    groups: DataFrame
    tables: calls.SignalTables
    evidence: Evidence
    reported: DataFrame
    consensus: DataFrame
    sites: DataFrame
    concs: list[int]
    # Per sample of the whole run: places in the sheet, alignments before and after duplicate removal.
    samples: DataFrame


def analyse(sheet: DataFrame, alignments: DataFrame, params: Params, genome: DataFrame | None = None,
            chunk: int = 4096, contigs: DataFrame | None = None) -> tuple[list[Analysis], DataFrame]:
    """Site lists of all groups of a validated sample sheet, and the count statistics per sample.

    Groups are analysed together; only groups with different replicate numbers, which have other
    table widths, form separate analyses.
    """
    samples = groups.with_ids(sheet)
    groups.require_valid(samples, params.use_umis)
    made = stage(groups.replicate_groups(samples, groups.control_limits(samples)), "groups")
    info = samples.groupBy("grp").agg(F.max("on_target_motif").alias("on_target_motif"),
                                      F.max("on_target_location").alias("on_target_location"))
    pairs = stage(groups.test_control_pairs(made).join(F.broadcast(info), "grp"), "pairs")

    given = alignments
    if params.use_umis:
        # Read by the counts and by the statistics of duplicates.
        alignments = stage(dedup.directional_umi(given), "molecules-kept")
    per_sample = stage(_per_sample(samples, given, alignments if params.use_umis else None), "samples")
    classified = stage(reads.classify(alignments, params).select(
        "sample_id", "chrom", "start", "low_mapq", "over_clip", "short", "passing"), "classified")
    # Read by the statistics and by every replicate class.
    counts = stage(reads.read_start_counts(classified), "counts")
    stats = stage(reads.count_stats(classified, counts), "count-stats")
    if params.apply_normalization:
        counts = reads.per_million(counts, stats)

    # One row per sample of the sheet: its group and its place among the group's replicates.
    members = made.select("grp", F.posexplode("sample_ids").alias("at", "sample_id")).select(
        "grp", "sample_id", (F.col("at") + 1).alias("rep"))
    placed = counts.join(F.broadcast(members), "sample_id")
    # As many kinds as the sheet has different replicate numbers.
    kinds = [(r.n_reps, r.control_reps) for r in
             pairs.select("n_reps", "control_reps").distinct().orderBy("n_reps", "control_reps").collect()]
    results = []
    for n, m in kinds:
        mine = pairs.filter((F.col("n_reps") == n) & (F.col("control_reps") == m)).drop("n_reps", "control_reps")
        concs = [r.conc for r in mine.select("conc").distinct().orderBy("conc").collect()]
        ours = mine.select("grp").unionByName(mine.select(F.col("control_grp").alias("grp"))).distinct()
        merged = reads.merge_replicates(placed.join(F.broadcast(ours), "grp", "left_semi"), range(1, max(n, m) + 1))
        tables = calls.signal_tables(merged, mine, n, m, params, contigs)
        evidence = tables.evidence(n, m, params)
        reported = stage(calls.reported_sites(tables, mine, evidence, params, genome, chunk), "reported")
        best = stage(calls.consensus_sites(reported, mine, tables, evidence, params), "consensus")
        sites = aggregate.pivot_concentrations(best, concs, n, m, params)
        results.append(Analysis(n, m, mine, tables, evidence, reported, best, sites, concs, per_sample))
    return results, stats


def _per_sample(samples: DataFrame, given: DataFrame, kept: DataFrame | None) -> DataFrame:
    """Samples of the sheet with their alignments before and after duplicate removal."""
    counted = given.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("input_reads"), F.count_if(cg.is_primary(F.col("flag"))).alias("aligned_reads"))
    rows = samples.select("sample_id", "sample_group", "replicate", "concentration").join(counted, "sample_id", "left")
    if kept is None:
        return rows.withColumn("total_dedup_umis", F.lit(None).cast("long")).withColumn("pct_duplication", F.lit(None).cast("double"))
    after = dedup.dedup_stats(given, kept).select("sample_id", "total_dedup_umis", "pct_duplication")
    return rows.join(after, "sample_id", "left")


def run_metrics(result: Analysis, stats: DataFrame, preprocessed: Preprocessed | None = None) -> DataFrame:
    """Metrics per sample from the run itself; fields of the read filters are NULL where reads were not filtered here."""
    counted = result.samples.select("sample_id")
    number = lambda *names: [F.lit(None).cast("long").alias(c) for c in names]
    reads_ = preprocessed.read_report if preprocessed else counted.select(
        "sample_id", *number("total_reads", "lowq_reads", "too_many_n_reads", "short_reads", "reads_passing_filter"),
        F.lit(None).cast("double").alias("pct_q30_reads_pf"))
    umis = preprocessed.umi_report if preprocessed else None
    has_umis = "total_dedup_umis" in result.samples.columns
    return qc.qc_metrics(
        result.samples.select("sample_id", "sample_group", "replicate", "concentration"), reads_, umis, result.samples,
        result.samples if has_umis else None, stats)


def publish(results: list[Analysis], stats: DataFrame, out: str, metrics: DataFrame | None = None,
            params: Params | None = None, version: str = "", preprocessed: Preprocessed | None = None,
            genome: str = "genome") -> None:
    """Write every table of a run below ``out``, one folder per kind and replicate class.

    The number of jobs does not depend on the number of sample groups.  Without ``metrics`` those of the run are
    written, with the fields of ``preprocessed`` if the reads were filtered by this library.
    """
    params = params or Params()
    sink.write_reports(sink.count_report(stats), os.path.join(out, "count_stats"))
    if metrics is None and results:
        metrics = run_metrics(results[0], stats, preprocessed)
    if metrics is not None:
        metrics = stage(metrics, "metrics")
        sink.write_metrics(metrics, os.path.join(out, "metrics"))
    panels: list[list[str]] = []
    for result in results:
        place = os.path.join(out, f"{result.n}x{result.m}_replicates")
        tables = result.tables
        for name in ("test_sums", "control_sums", "wide_sums", "diffs"):
            sink.write_signal(getattr(tables, name), os.path.join(place, name))
        for name in ("test_peak_hist", "control_peak_hist", "wide_hist"):
            sink.write_histogram(getattr(tables, name), os.path.join(place, name))
        panels += tracks.write_tracks(tables.test_sums, range(1, result.n + 1), os.path.join(place, "tracks"), out)
        sink.write_sites(result.reported, os.path.join(place, "reported_sites"), ["grp", "rank"])
        sink.write_sites(result.sites, os.path.join(place, "sites"), ["sample_group", "rank"])
        hists = tables.test_peak_hist.select("grp", "mean", "cnt").unionByName(
            tables.control_peak_hist.select("grp", "mean", "cnt"))
        report.write_reports(os.path.join(place, "reports"), result.groups, result.sites, result.concs, hists, metrics,
                             result.evidence, params, version)
    if results:
        session = tracks.browser_session(genome, panels)
        files.write_named(stats.sparkSession.createDataFrame([("session.xml", session)], "name string, content string"), out)
