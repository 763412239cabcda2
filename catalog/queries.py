"""Every operator as a query on the given tables; ``oracles.py`` holds the SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import adapters as src
from locuswave.functions import cigar as cg
from locuswave.functions import coords, display, dna
from locuswave.operators import (
    adapters, aggregate, calling, dedup, groups, intervals, islands, motif, nulls, peaks, qc, ranking, reads, sampling, signal,
)
from locuswave.params import Params
from locuswave.plans import calls
from locuswave.schema import mean_of, value_names
from locuswave.session import run_path, stage, together
from locuswave.sinks import tables as sink
from locuswave.sources import ranges, sequences
from locuswave.sources import tables as source_tables

N = len(src.REPS)
VALUES = value_names(N)
# The tables are small: p-values cannot fall below 1/n, so thresholds are relaxed.
PARAMS = Params(test_pval_calling_thresh=2e-3, test_pval_reporting_thresh=1e-2)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def conc() -> Column:
    return F.col("grp").cast("int").alias("conc")


def plain(df: DataFrame, *columns: str, values: list[str] = VALUES) -> DataFrame:
    return df.select(conc(), *columns, *[F.col(v).cast("double").alias(v) for v in values])


# -- reads and counts --------------------------------------------------------------------------


@query
def alignment_filter_stats(spark, sf):
    return reads.count_stats(reads.classify(src.alignments(spark, sf), PARAMS))


@query
def read_start_counts(spark, sf):
    return reads.read_start_counts(reads.classify(src.alignments(spark, sf), PARAMS))


@query
def per_million_norm(spark, sf):
    classified = reads.classify(src.alignments(spark, sf), PARAMS)
    totals = classified.groupBy("sample_id").agg(F.count(F.lit(1)).alias("total_reads"))
    normed = reads.per_million(reads.read_start_counts(classified), totals)
    return normed.select("sample_id", "chrom", "pos", F.round(F.col("n").cast("double"), 6).alias("n"))


@query
def cigar_reflen(spark, sf):
    a = src.alignments(spark, sf)
    flag, cigar = F.col("flag"), F.col("cigar")
    length = cg.reference_length(cigar)
    return a.select(
        "read_id", "chrom", "cigar", length.alias("ref_length"), cg.five_prime_clip(cigar, flag).alias("start_clip"),
        cg.read_start(F.col("pos"), flag, length).alias("read_start"), cg.is_primary(flag).alias("is_primary"))


@query
def merge_read_starts(spark, sf):
    return plain(src.counts(spark, sf), "chrom", "pos")


# -- windows -----------------------------------------------------------------------------------


@query
def window_sums_w5(spark, sf):
    return plain(signal.window_sums(src.counts(spark, sf), N, PARAMS.stat_window), "chrom", "start", "stop")


@query
def window_sums_w150(spark, sf):
    return plain(signal.window_sums(src.counts(spark, sf), N, PARAMS.control_noise_window), "chrom", "start", "stop")


@query
def window_sums_contig_clipped(spark, sf):
    sums = signal.window_sums(src.counts(spark, sf), N, PARAMS.control_noise_window, contigs=src.contigs(spark, sf))
    return plain(sums, "chrom", "start", "stop")


@query
def window_sums_normalized(spark, sf):
    sums = signal.window_sums(normalized_counts(spark, sf), N, PARAMS.stat_window)
    return sums.select(conc(), "chrom", "start", "stop",
                       *[F.round(F.col(v).cast("double"), 4).alias(v) for v in VALUES])


def normalized_counts(spark, sf):
    raw = src.reads(spark, sf)
    per_sample = raw.withColumn("sample_id", F.concat_ws("_", "grp", "rep"))
    counts = per_sample.groupBy("sample_id", "grp", "rep", "chrom", "pos").agg(F.count(F.lit(1)).alias("n"))
    totals = per_sample.groupBy("sample_id").agg(F.count(F.lit(1)).alias("total_reads"))
    return reads.merge_replicates(reads.per_million(counts, totals), src.REPS)


@query
def window_sum_dist(spark, sf):
    sums = signal.window_sums(controls(spark, sf), N, PARAMS.control_noise_window)
    hist = signal.value_histogram(sums, N)
    return hist.select(conc(), F.col("total").cast("double").alias("total"), "mean", "cnt")


def controls(spark, sf):
    return src.counts(spark, sf).filter(F.col("grp") == src.CONTROL)


def difference(spark, sf):
    counts = src.counts(spark, sf)
    control = signal.fan_out_control(counts.filter(F.col("grp") == src.CONTROL), src.groups(spark, sf))
    return signal.window_diffs(counts.filter(F.col("grp") != src.CONTROL), control, N, PARAMS.stat_window)


def null_peaks(spark, sf):
    return peaks.signal_peaks(signal.self_diffs(controls(spark, sf), N, PARAMS.stat_window), N, PARAMS.peak_window)


@query
def window_diffs(spark, sf):
    return plain(difference(spark, sf), "chrom", "start", "stop")


@query
def ctrl_self_diffs(spark, sf):
    return plain(signal.self_diffs(controls(spark, sf), N, PARAMS.stat_window), "chrom", "start", "stop")


@query
def rotated_controls(spark, sf):
    return plain(signal.rotate(controls(spark, sf), N), "chrom", "pos")


@query
def signal_peaks(spark, sf):
    return plain(peaks.signal_peaks(difference(spark, sf), N, PARAMS.peak_window), "chrom", "pos")


@query
def site_lists_round_trip(spark, sf):
    """Peaks of both concentrations written as lists with head lines and read back together."""
    path = run_path(spark, "lists")
    found = stage(peaks.signal_peaks(difference(spark, sf), N, PARAMS.peak_window), "peaks")
    listed = found.select(F.concat(F.lit("guide_"), "grp", F.lit("nM")).alias("identifier"), F.col("grp").cast("int").alias("conc"),
                          "chrom", "pos", F.array(*[F.col(v).cast("double") for v in VALUES]).alias("vals"))
    sink.write_site_lists(listed, path, ["chrom", "pos"], identifier="identifier")
    layout = listed.drop("identifier", "conc").schema
    back = source_tables.read_site_lists(spark, [path], layout)
    return back.select("identifier", "concentration", "chrom", "pos",
                       *[F.get("vals", F.lit(k)).alias(v) for k, v in enumerate(VALUES)])


@query
def ctrl_peak_dist(spark, sf):
    hist = peaks.peak_histogram(null_peaks(spark, sf), N)
    return hist.select(conc(), F.col("total").cast("double").alias("total"), "mean", "cnt")


@query
def event_islands(spark, sf):
    """Islands with the time axis as distance: the strongest event of each burst of a user."""
    events = src.table(spark, sf, "events").select(
        F.col("user_id"), "event_id", "value",
        F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)").alias("t"))
    best = islands.island_best(
        events, ["user_id"], gap=3_600_000_000, priority=[F.col("value"), F.col("event_id")],
        payload=["event_id", "value"], start="t", stop="t", tile=24 * 3_600_000_000)
    return best.select("user_id", "island_start", "island_stop", "members", "event_id", "value")


# -- null distributions ------------------------------------------------------------------------


def price_null(spark, sf):
    """Line prices as a null with many distinct values."""
    item = src.table(spark, sf, "lineitem")
    return item.groupBy(F.lit("price").alias("null_id"), nulls.rounded(F.col("l_extendedprice")).alias("stat")).agg(
        F.count(F.lit(1)).alias("cnt"))


@query
def ecdf_pvalues(spark, sf):
    made = together(
        null=lambda: stage(nulls.null_from_histogram(peaks.peak_histogram(null_peaks(spark, sf), N)), "null"),
        points=lambda: peaks.signal_peaks(difference(spark, sf), N, PARAMS.peak_window))
    points = made["points"].withColumn("null_id", F.lit(src.CONTROL))
    tested = nulls.with_p_value(points, made["null"], mean_of(N), "null_id", "p")
    return tested.select(conc(), "chrom", "pos", F.round("p", 12).alias("p"))


@query
def ecdf_price_pvalues(spark, sf):
    """Order totals against the distribution of line prices: long axis, interpolated values."""
    orders = src.table(spark, sf, "orders").withColumn("null_id", F.lit("price"))
    tested = nulls.with_p_value(orders, price_null(spark, sf), F.col("o_totalprice") / 4, "null_id", "p")
    return tested.select("o_orderkey", F.round("p", 12).alias("p"))


@query
def ecdf_thresholds(spark, sf):
    null = nulls.null_from_histogram(peaks.peak_histogram(null_peaks(spark, sf), N))
    levels = {"median": 0.5, "tenth": 0.1, "reporting": 1e-2, "calling": 2e-3, "floor": 1e-9}
    found = nulls.thresholds(null, levels)
    return found.select("name", "p", F.round("value", 6).alias("value"))


@query
def ecdf_price_thresholds(spark, sf):
    levels = {"median": 0.5, "tenth": 0.1, "thousandth": 1e-3, "one": 1.0}
    return nulls.thresholds(price_null(spark, sf), levels).select("name", "p", F.round("value", 4).alias("value"))


# -- lookups -----------------------------------------------------------------------------------


@query
def interval_join_wide(spark, sf):
    """Wide control sums at every test position, zero where no run covers it."""
    points = src.counts(spark, sf).filter(F.col("grp") != src.CONTROL).select(
        "grp", "chrom", "pos", F.lit(src.CONTROL).alias("control_grp"))
    sums = signal.window_sums(controls(spark, sf), N, PARAMS.stat_window)
    found = intervals.lookup(points, sums, N, "w", grp="control_grp")
    return plain(found, "chrom", "pos", values=value_names(N, "w"))


@query
def region_scan(spark, sf):
    """Runs of a region from a written table: its range index names the files to read."""
    path = run_path(spark, "sums")
    sink.write_signal(signal.window_sums(src.counts(spark, sf), N, PARAMS.stat_window), path)
    return plain(ranges.read_region(spark, path, "chr2", 1_000, 5_000), "chrom", "start", "stop")


# -- calling -----------------------------------------------------------------------------------


def tables(spark, sf):
    return calls.signal_tables(src.counts(spark, sf), src.groups(spark, sf), N, N, PARAMS)


def site_stage(spark, sf, genome=None):
    groups_ = stage(src.groups(spark, sf), "groups")
    made = tables(spark, sf)
    evidence = made.evidence(N, N, PARAMS)
    kwargs = dict(genome=genome, chunk=src.CHUNK) if genome is not None else {}
    return groups_, made, evidence, calls.reported_sites(made, groups_, evidence, PARAMS, **kwargs)


def with_floats(df: DataFrame, digits: int = 9) -> DataFrame:
    return df.select(*[
        F.round(F.col(c.name).cast("double"), digits).alias(c.name)
        if c.dataType.typeName() in ("double", "decimal") else F.col(c.name) for c in df.schema])


@query
def reported_sites(spark, sf):
    sites = site_stage(spark, sf)[3]
    numbers = [*VALUES, *value_names(N, "t"), *value_names(N, "c"), *value_names(N, "w")]
    return with_floats(sites.select(
        conc(), "chrom", F.col("pos").alias("position"), "position_1b", "rank", "test_pval", "background_pval",
        "digested", "high_background", "site_called", "mean_signal",
        F.col("mean_wide_control_reads"),
        *[F.col(c).cast("double").alias(c) for c in ["total_signal", "total_test_reads", "total_control_reads",
                                                     "total_wide_control_reads"]],
        *[F.col(c).cast("double").alias(c) for c in numbers]))


@query
def pct_max_peak(spark, sf):
    sites = site_stage(spark, sf)[3]
    return with_floats(sites.select(conc(), "chrom", "pos", *value_names(N, "pct"), "mean_pct_max_peak"))


@query
def on_target_sites(spark, sf):
    """Reported sites with their closest motif; the score is checked by SQL, the span by tests."""
    sites = site_stage(spark, sf, genome=src.genome(spark, sf))[3]
    return sites.select(conc(), "chrom", "pos", "motif_score")


def on_motif(column: str):
    return F.when(F.col("is_on_target"), F.col(column)).otherwise(F.lit("-")).alias(column)


@query
def on_target_ranks(spark, sf):
    """Reported sites of a genome that holds the guide's sequence: the on-target is first and has rank 0."""
    sites = site_stage(spark, sf, genome=src.genome_with_target(spark, sf))[3]
    return sites.select(conc(), "chrom", "pos", "rank", "is_on_target", "motif_score", on_motif("closest_motif"), on_motif("motif_location"))


def target_consensus(spark, sf):
    groups_, made, evidence, sites = site_stage(spark, sf, genome=src.genome_with_target(spark, sf))
    return stage(calls.consensus_sites(sites, groups_, made, evidence, PARAMS), "target-consensus")


@query
def on_target_consensus(spark, sf):
    """Consensus ranks with the on-target, and the motif fields that its concentrations share."""
    wide = aggregate.pivot_concentrations(target_consensus(spark, sf), [64, 256], N, N, PARAMS)
    return with_floats(wide.select("chrom", "position", "rank", "is_on_target", on_motif("closest_motif"), on_motif("motif_location"),
                                   "64nM_site_called", "256nM_site_called", "256nM_mean_signal"))


@query
def on_target_breakdown(spark, sf):
    wide = aggregate.pivot_concentrations(target_consensus(spark, sf), [64, 256], N, N, PARAMS)
    return with_floats(aggregate.called_breakdown(wide, [64, 256]).drop("sample_group"))


@query
def site_conc_grid(spark, sf):
    groups_, made, evidence, sites = site_stage(spark, sf)
    grid = aggregate.complete_grid(sites, groups_, made.diffs, evidence, PARAMS)
    return with_floats(grid.select(
        "conc", "chrom", "pos", "site_called", "digested", "high_background", "test_pval", "background_pval",
        *[F.col(c).cast("double").alias(c) for c in aggregate.value_columns(N, N)]))


def consensus(spark, sf):
    groups_, made, evidence, sites = site_stage(spark, sf)
    return calls.consensus_sites(sites, groups_, made, evidence, PARAMS)


@query
def consensus_sites(spark, sf):
    best = consensus(spark, sf)
    return with_floats(best.select(
        "chrom", "pos", "rank", F.get("called_signals", F.lit(0)).alias("signal_64"),
        F.get("called_signals", F.lit(1)).alias("signal_256"), F.col("total_signal").cast("double").alias("total_signal")))


@query
def aggregate_pivot(spark, sf):
    wide = aggregate.pivot_concentrations(consensus(spark, sf), [64, 256], N, N, PARAMS)
    fields = ["site_called", "test_pval", "mean_signal", "mean_pct_max_peak"]
    return with_floats(wide.select(
        "chrom", "position", "rank", "background_pval", "high_background",
        F.col("total_control_reads").cast("double").alias("total_control_reads"),
        F.col("mean_wide_control_reads").cast("double").alias("mean_wide_control_reads"),
        *[F.col(f"{c}nM_{f}") for c in (64, 256) for f in fields],
        *[F.col(f"{c}nM_total_test_reads").cast("double").alias(f"{c}nM_total_test_reads") for c in (64, 256)]))


@query
def unpivot_concentrations(spark, sf):
    """The wide table back in long form, concentrations read off the column names."""
    wide = aggregate.pivot_concentrations(consensus(spark, sf), [64, 256], N, N, PARAMS)
    long = aggregate.unpivot_concentrations(wide)
    return with_floats(long.select("conc", "chrom", "position", "rank", "site_called", "test_pval", "mean_signal"))


@query
def called_breakdown(spark, sf):
    wide = aggregate.pivot_concentrations(consensus(spark, sf), [64, 256], N, N, PARAMS)
    return with_floats(aggregate.called_breakdown(wide, [64, 256]).drop("sample_group"))


@query
def ranked_orders(spark, sf):
    """Distributed rank on the whole order table, ties broken down to a unique order."""
    orders = src.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    ranked = ranking.ordinal(orders, ["o_orderpriority"],
                             [F.asc("o_orderstatus"), F.desc("o_totalprice"), F.asc("o_orderkey")], "rank")
    return ranked.select("o_orderkey", "rank")


# -- sample sheet ------------------------------------------------------------------------------


@query
def replicate_groups(spark, sf):
    samples = groups.with_ids(src.sample_sheet(spark, sf))
    made = groups.replicate_groups(samples)
    return made.select("grp", "sample_group", "concentration", "n_reps",
                       F.array_join(F.col("replicates").cast("array<string>"), ",").alias("reps"),
                       F.array_join("sample_ids", ",").alias("sample_ids"))


@query
def replicate_group_sizes(spark, sf):
    return groups.group_sizes(groups.with_ids(src.sample_sheet(spark, sf)))


@query
def sheet_violations(spark, sf):
    return groups.violations(groups.with_ids(src.sample_sheet(spark, sf)))


@query
def sheet_rules(spark, sf):
    """Every rule on a large sheet with every fault."""
    return groups.violations(groups.with_ids(src.faulty_sheet(spark, sf)))


@query
def control_limits(spark, sf):
    """Replicates per test group and control on the large grouping table, uneven controls included."""
    rows = src.trading_groups(spark, sf)
    sizes = rows.filter("concentration > 0").groupBy("control_group", "sample_group").agg(F.count(F.lit(1)).alias("k"))
    return sizes.groupBy("control_group").agg(
        F.min("k").alias("least"), F.max("k").alias("most"), F.countDistinct("k").alias("sizes"))


@query
def unmatched_groups(spark, sf):
    """Outer-join check: nations no customer refers to, and customers without orders."""
    customer, orders = src.table(spark, sf, "customer"), src.table(spark, sf, "orders")
    nation = src.table(spark, sf, "nation")
    idle = customer.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select(
        F.lit("customer_without_order").alias("kind"), F.col("c_custkey").cast("long").alias("id"))
    unused = nation.join(customer, F.col("n_nationkey") == F.col("c_nationkey"), "left_anti").select(
        F.lit("nation_without_customer").alias("kind"), F.col("n_nationkey").cast("long").alias("id"))
    return idle.unionByName(unused)


@query
def keyed_equi_join(spark, sf):
    """Join with cardinality checks: every order total meets exactly one order."""
    orders = src.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    status = src.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return groups.keyed_join(orders, status, ["o_orderkey"])


# -- quality and duplicates --------------------------------------------------------------------


@query
def umi_quality_filter(spark, sf):
    flagged = qc.umi_flags(src.read_pairs(spark, sf), PARAMS)
    return with_floats(qc.umi_report(flagged), 6)


@query
def read_quality_filter(spark, sf):
    flagged = qc.read_flags(src.read_pairs(spark, sf), PARAMS)
    return with_floats(qc.read_report(flagged), 6)


@query
def adapter_trim(spark, sf):
    """Fragment lengths by the overlap of the mates, and the reads cut to them."""
    pairs = src.overlapping_pairs(spark, sf)
    known = adapters.with_inserts(pairs).select(
        "read_id", *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("insert_length", "mismatches")])
    cut = adapters.trim(pairs).select("read_id", "seq1", "seq2", F.length("qual1").alias("qual1_length"), "trimmed_bases")
    return groups.keyed_join(known, cut, ["read_id"])


@query
def trimmed_read_filter(spark, sf):
    """Read filter after adapter removal; some reads are shorter than a UMI."""
    flagged = qc.read_flags(adapters.trim(src.overlapping_pairs(spark, sf)), PARAMS)
    return with_floats(qc.read_report(flagged), 6)


@query
def umi_extract(spark, sf):
    return qc.extract_umi(src.read_pairs(spark, sf), PARAMS).select("read_id", "seq1", "umi")


@query
def umi_dedup_exact(spark, sf):
    return dedup.exact_umi(src.alignments(spark, sf)).select("sample_id", "read_id", "chrom", "pos", "umi", "mapq")


@query
def umi_dedup_directional(spark, sf):
    """One alignment per place and cluster of UMIs one substitution apart."""
    return dedup.directional_umi(src.alignments(spark, sf)).select("sample_id", "read_id", "chrom", "pos", "umi")


@query
def umi_dedup_crowded(spark, sf):
    """The same where thousands of UMIs share a place."""
    return dedup.directional_umi(src.crowded_alignments(spark, sf)).select("sample_id", "read_id", "chrom", "umi", "mapq")


@query
def fastq_round_trip(spark, sf):
    """Read pairs written as blocked-gzip FASTQ and read back by many tasks, mates paired by their order."""
    path = run_path(spark, "fastq")
    sink.write_fastq(src.read_pairs(spark, sf), path)
    return sequences.read_fastq(spark, sink.fastq_sheet(spark, path), split_bytes=1 << 20)


@query
def dedup_stats(spark, sf):
    before = src.alignments(spark, sf)
    return with_floats(dedup.dedup_stats(before, dedup.exact_umi(before)), 6)


@query
def qc_metrics(spark, sf):
    """Metrics per sample over read pairs and alignments; samples are the three replicates."""
    pairs = src.read_pairs(spark, sf)
    flagged = stage(qc.umi_flags(qc.read_flags(pairs, PARAMS), PARAMS), "flagged")
    umis = qc.umi_report(flagged.filter("read_ok"))
    a = src.alignments(spark, sf).withColumn("sample_id", F.concat(F.lit("D_R"), F.substring("sample_id", -1, 1)))
    primary = a.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("input_reads"), F.count_if(cg.is_primary(F.col("flag"))).alias("aligned_reads"))
    kept = stage(dedup.exact_umi(a), "kept")
    counted = reads.count_stats(reads.classify(kept, PARAMS))
    samples = pairs.select("sample_id").distinct().select(
        "sample_id", F.lit("D").alias("sample_group"), F.substring("sample_id", -1, 1).cast("int").alias("replicate"),
        F.lit(64).alias("concentration"))
    metrics = qc.qc_metrics(samples, qc.read_report(flagged), umis, primary, dedup.dedup_stats(a, kept), counted)
    return with_floats(metrics, 6)


@query
def subsample(spark, sf):
    return sampling.subsample(src.alignments(spark, sf), target=500).select("sample_id", "read_id")


# -- scalar functions --------------------------------------------------------------------------


@query
def reverse_complement(spark, sf):
    seq = F.expr("concat(translate(md5(p_name), '0123456789abcdef', 'ACGTRYSWKMBVDHNA'), 'acgtn-')")
    part = src.table(spark, sf, "part").withColumn("seq", seq)
    return part.select("p_partkey", "seq", dna.reverse_complement(F.col("seq")).alias("rc"))


@query
def iupac_ungapped_motif(spark, sf):
    """Matching letters of a degenerate motif at every offset of every part's sequence."""
    part = src.table(spark, sf, "part").select("p_partkey", F.expr(
        "translate(md5(concat(p_partkey, p_name)), '0123456789abcdef', 'ACGTACGTACGTACGT')").alias("seq"))
    laid = part.withColumn("place", F.explode(F.sequence(F.lit(0), F.length("seq") - 5)))
    hits = dna.matches_at("NGRYA", F.col("seq"), F.col("place"))
    return laid.select("p_partkey", "place", hits.alias("hits"))


@query
def motif_semiglobal(spark, sf):
    """Gapped best-match score of the motif on both strands of every part's sequence."""
    part = src.table(spark, sf, "part").select("p_partkey", F.expr(
        "translate(md5(concat(p_partkey, p_name)), '0123456789abcdef', 'ACGTACGTACGTACGT')").alias("window"))
    cheap = Params(motif_gap_pen=2, motif_mismatch_pen=2, motif_match_score=3)
    found = part.withColumn("m", motif.motif_udf(cheap)(F.lit("GATNACA"), F.col("window")))
    return found.select("p_partkey", F.col("m.score").alias("score"))


@query
def interval_ops(spark, sf):
    s = src.spans(spark, sf)
    a = coords.Span(F.col("chrom_a"), F.col("start_a"), F.col("stop_a"), F.col("rev_a"))
    b = coords.Span(F.col("chrom_b"), F.col("start_b"), F.col("stop_b"), F.col("rev_b"))
    za, zb = a.to_zero_based(), b.to_zero_based()
    inter, rest = a.intersection(b, ignore_strand=True), a.difference(b, ignore_strand=True)
    clipped, grown = a.clip_5prime(F.lit(3)), a.extend_3prime(F.lit(4))
    back = coords.Span.parse(a.text())
    return s.select(
        "l_orderkey", "l_linenumber", "l_partkey", "chrom_b", "start_b", "stop_b", "rev_a", "rev_b",
        a.text().alias("text"), za.text(stranded=False).alias("zero_text"), a.length().alias("len_a"),
        za.length().alias("zero_len"), a.overlaps(b).alias("overlaps"), za.overlaps(zb, True).alias("zero_overlaps"),
        F.coalesce(inter["start"], F.lit(-1)).alias("inter_start"),
        F.coalesce(inter["stop"], F.lit(-1)).alias("inter_stop"), F.size(rest).alias("pieces"),
        F.aggregate(rest, F.lit(0).cast("long"), lambda n, p: n + p["stop"] - p["start"] + 1).alias("rest_len"),
        a.is_5prime_of(b).alias("is_5prime"), a.is_3prime_of(b).alias("is_3prime"),
        za.is_5prime_of(zb).alias("zero_5prime"), clipped.start.alias("clip_start"), clipped.stop.alias("clip_stop"),
        grown.start.alias("grown_start"), grown.stop.alias("grown_stop"), a.boundary_5prime().alias("end5"),
        back.start.alias("parsed_start"), back.reverse.alias("parsed_rev"))


@query
def combined_spans(spark, sf):
    s = src.spans(spark, sf)
    packed = coords.Span(F.lit("chr1"), F.col("start_a"), F.col("stop_a"), F.col("rev_a")).pack()
    made = coords.combine(s.select("l_orderkey", F.explode(F.array(packed, packed)).alias("span")), ["l_orderkey"])
    return made.select("l_orderkey", "span.start", "span.stop", F.col("span.is_reverse_strand").alias("is_reverse"))


@query
def on_target_overlap(spark, sf):
    s = src.spans(spark, sf)
    found = F.concat(F.lit("chr1:"), F.col("start_a").cast("string"), F.lit("-"), F.col("stop_a").cast("string"), F.lit(",-"))
    target = F.concat(F.lit("chr1:"), F.col("start_b").cast("string"), F.lit("-"), F.col("stop_b").cast("string"), F.lit(",+"))
    return s.select("l_orderkey", "l_linenumber", "l_partkey", "start_b", coords.on_target(found, target).alias("hit"))


@query
def cut_sites(spark, sf):
    s = src.table(spark, sf, "orders")
    text = F.expr("concat('chr1:', o_custkey, ',+;chr1:', o_custkey, ',-;chr', o_orderkey % 5, ':', o_orderkey, ',+;')")
    return s.select("o_orderkey", F.array_join(coords.cut_sites(text), ";").alias("sites"))


@query
def display_formats(spark, sf):
    o = src.table(spark, sf, "orders")
    location = F.expr("concat('chr1:', o_orderkey + 1000, '-', o_orderkey + 1022, ',+')")
    return o.select(
        "o_orderkey", display.integer(F.col("o_custkey") * 1000).alias("n"),
        display.coordinate(location).alias("place"),
        dna.base_name(F.expr("concat('/data/run/sample', o_orderkey, '.sorted.bam')")).alias("base"),
        dna.is_compressed(F.expr("concat('x', o_orderkey, case when o_orderkey % 2 = 0 then '.tsv.bgz' else '.tsv' end)")).alias("zipped"))


@query
def bedgraph_unpivot(spark, sf):
    from locuswave.sinks.tracks import bedgraph_rows

    rows = bedgraph_rows(signal.window_sums(src.counts(spark, sf), N, PARAMS.stat_window), src.REPS)
    return rows.select(conc(), "rep", "chrom", "start", "stop", "value")


@query
def track_zoom(spark, sf):
    """All zoom levels of the window sums, written and read back."""
    from locuswave.sinks import zoom
    from locuswave.sinks.tracks import bedgraph_rows

    path = run_path(spark, "zoom")
    zoom.write_zoom(bedgraph_rows(signal.window_sums(src.counts(spark, sf), N, PARAMS.stat_window), src.REPS), path)
    return spark.read.parquet(path).select(
        F.col("level").cast("int").alias("level"), conc(), "rep", "chrom", "start", "stop", "least", "greatest", "total",
        "covered")


@query
def peak_plot_histogram(spark, sf):
    from locuswave.plans.report import plot_bins

    hist = peaks.peak_histogram(peaks.signal_peaks(difference(spark, sf), N, PARAMS.peak_window), N)
    return plot_bins(hist).select(conc(), "bin", "bin_start", "sites")


@query
def lane_union(spark, sf):
    """Lanes of a sample numbered in file order."""
    o = src.table(spark, sf, "orders").select(
        F.expr("concat('c', o_custkey)").alias("sample_id"), F.expr("concat('lane', o_orderkey, '.fastq.gz')").alias("fastq_1"))
    return groups.lanes(o)
