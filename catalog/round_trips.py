"""Queries that write the published file formats from the given tables and read them back, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import adapters as src
from catalog.oracles import ALN, COUNTS, CTRL, DOUBLES, PEAKS, RUN, SELF, SHEET, define, expanded
from catalog.oracles import ORACLES
from catalog.queries import N, PARAMS, VALUES, conc, difference, null_peaks, plain, query
from locuswave.operators import groups, peaks, reads, signal
from locuswave.session import run_path, stage
from locuswave.sinks import files
from locuswave.sinks import tables as sink
from locuswave.sources import sequences, tables
from locuswave.streaming.islands import running_islands


@query
def sam_round_trip(spark, sf):
    """Alignments as blocked-gzip SAM text, one file set per sample, read back with their UMIs."""
    path = run_path(spark, "sam")
    a = src.alignments(spark, sf)
    line = F.concat_ws("\t", F.concat_ws("_", "read_id", "umi"), F.col("flag").cast("string"), "chrom",
                       (F.col("pos") + 1).cast("string"), F.col("mapq").cast("string"), "cigar", F.lit("*\t0\t0\t*\t*"))
    head = F.lit("@HD\tVN:1.6\n@SQ\tSN:chr0\tLN:1000000")
    files.write_blocked_gzip(a.select(F.col("sample_id").alias("folder"), head.alias("head"), line.alias("line"))
                             .sortWithinPartitions("folder"), path, "sam.gz")
    samples = [r.sample_id for r in a.select("sample_id").distinct().collect()]  # one per flag and replicate
    back = None
    for sample in samples:
        read = sequences.read_sam(spark, sample, f"{path}/{sample}")
        back = read if back is None else back.unionByName(read)
    return back.withColumn("read_id", F.substring_index("read_id", "_", 1))


@query
def genome_round_trip(spark, sf):
    """Contigs as FASTA in blocked gzip, read back by many tasks in chunks of another size."""
    path = run_path(spark, "genome")
    chunks = src.genome(spark, sf).repartition("chrom").sortWithinPartitions("chrom", "chunk_id")
    files.write_blocked_gzip(chunks.select(
        F.col("chrom").alias("folder"), F.concat(F.lit(">"), "chrom", F.lit(" made")).alias("head"),
        F.col("seq").alias("line")), path, "fa.gz")
    return sequences.read_fasta(spark, path, chunk=1000, split_bytes=1 << 16)


@query
def contig_lengths(spark, sf):
    """Contig lengths of the genome written as an index and read back."""
    path = run_path(spark, "index")
    lengths = sequences.contigs_of(src.genome(spark, sf), src.CHUNK)
    lengths.select("chrom", "length", F.lit(6), F.lit(60), F.lit(61)).write.option("sep", "\t").csv(path)
    return sequences.read_fai(spark, path)


@query
def signal_text_round_trip(spark, sf):
    """Window sums of a group as gzip text with a header, in coordinate order over its files."""
    path = run_path(spark, "signal")
    counts = src.counts(spark, sf).filter("grp = '64'")
    sink.write_signal_text(signal.window_sums(counts, N, PARAMS.stat_window), [f"s{k}" for k in range(N)], path)
    return plain(tables.read_signal(spark, path, "64"), "chrom", "start", "stop")


@query
def histogram_round_trip(spark, sf):
    """Null peak histogram written as text and read back."""
    path = run_path(spark, "histogram")
    sink.write_histogram(peaks.peak_histogram(null_peaks(spark, sf), N), path)
    back = tables.read_histogram(spark, f"{path}/grp={src.CONTROL}", src.CONTROL)
    return back.select(conc(), "total", F.round("mean", 6).alias("mean"), "cnt")


@query
def site_table_round_trip(spark, sf):
    """Peaks with their replicate vectors as a site table; vectors travel as JSON."""
    path = run_path(spark, "sites")
    found = stage(peaks.signal_peaks(difference(spark, sf), N, PARAMS.peak_window), "peaks")
    sites = found.select("grp", "chrom", "pos", F.array(*[F.col(v).cast("double") for v in VALUES]).alias("vals"))
    sink.write_sites(sites, path, ["grp", "chrom", "pos"])
    back = tables.read_sites(spark, path, sites.schema)
    return back.select(conc(), "chrom", "pos", *[F.get("vals", F.lit(k)).alias(v) for k, v in enumerate(VALUES)])


@query
def count_report_round_trip(spark, sf):
    """Count statistics as nested JSON reports, read back flat."""
    path = run_path(spark, "reports")
    stats = reads.count_stats(reads.classify(src.alignments(spark, sf), PARAMS))
    sink.write_reports(sink.count_report(stats), path)
    back = tables.read_count_report(spark, path)
    return back.groupBy("total_reads", "passing_reads", "total_sites", "low_mapping_quality", "above_clipping",
                        "below_ref_length").agg(F.count(F.lit(1)).alias("samples"))


@query
def sheet_round_trip(spark, sf):
    """The sample sheet as CSV, read with its formats checked."""
    path = run_path(spark, "sheet")
    src.sample_sheet(spark, sf).write.option("header", True).csv(path)
    return tables.read_sample_sheet(spark, path).select(
        "sample_group", F.coalesce("control_group", F.lit("-")).alias("control_group"), "concentration", "replicate",
        F.coalesce("on_target_location", F.lit("-")).alias("on_target_location"), "fastq_2")


def lane_sheet(spark, sf):
    """Tests with as many replicates as their control asks for, and controls with up to seven."""
    part, customer = src.table(spark, sf, "part"), src.table(spark, sf, "customer")
    text = F.lit(None).cast("string")
    tests = part.filter("p_partkey % 8 < 2 + p_partkey div 8 % 20 % 3").select(
        F.expr("concat('g', p_partkey div 8)").alias("sample_group"), F.expr("concat('ctl', p_partkey div 8 % 20)").alias("control_group"),
        F.lit(64).alias("concentration"), F.expr("cast(p_partkey % 8 + 1 as int)").alias("replicate"))
    ctl = customer.filter("c_custkey div 20 < 7").select(
        F.expr("concat('ctl', c_custkey % 20)").alias("sample_group"), text.alias("control_group"),
        F.lit(0).alias("concentration"), F.expr("cast(c_custkey div 20 + 1 as int)").alias("replicate"))
    return groups.with_ids(tests.unionByName(ctl).withColumn("on_target_motif", text).withColumn("on_target_location", text))


@query
def replicate_limits(spark, sf):
    """Tests paired with their controls; controls cut to the replicates their tests use."""
    samples = lane_sheet(spark, sf)
    made = groups.replicate_groups(samples, groups.control_limits(samples))
    return groups.test_control_pairs(made)


@query
def run_order(spark, sf):
    """Samples in the order of a run: position of every sample, controls first."""
    samples = lane_sheet(spark, sf)
    path = run_path(spark, "order")
    groups.controls_first(samples).select("sample_id").write.parquet(path)
    # The order of the written rows, by file and place.
    back = spark.read.parquet(path).select(
        "sample_id", F.struct("_metadata.file_name", F.monotonically_increasing_id().alias("k")).alias("at"))
    from locuswave.operators.ranking import ordinal

    return ordinal(back.withColumn("_all", F.lit(0)), ["_all"], [F.col("at")], "place").select("sample_id", "place")


@query
def event_islands_stream(spark, sf):
    """Bursts of events found while the events stream in; a last event far ahead closes them all."""
    folder, out = run_path(spark, "arriving"), run_path(spark, "closed")
    events = src.table(spark, sf, "events").select("user_id", "event_id", "value", F.col("ts").cast("timestamp").alias("ts"))
    events.write.parquet(folder)
    events.agg((F.max("ts") + F.expr("interval 30 days")).alias("ts")).select(
        F.lit(-1).cast("long").alias("user_id"), F.lit(-1).cast("long").alias("event_id"), F.lit(0.0).alias("value"), "ts",
    ).write.mode("append").parquet(folder)
    arriving = spark.readStream.schema(events.schema).parquet(folder)
    found = running_islands(arriving, ["user_id"], 3_600_000_000, "ts", "1 day", ["value", "event_id"], ["event_id", "value"])
    stream = found.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", run_path(spark, "stream")).trigger(availableNow=True).start()
    stream.awaitTermination()
    return spark.read.schema(found.schema).parquet(out).select(
        "user_id", "island_start", "island_stop", "members", "event_id", "value")


define("sam_round_trip", ALN, select="SELECT sample_id, read_id, chrom, pos, flag, mapq, cigar, umi FROM aln")
define("genome_round_trip", """whole AS (
  SELECT 'chr' || c AS chrom, string_agg(substr(translate(md5(o_orderkey || '-' || c), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 7), ''
                                         ORDER BY o_orderkey) AS seq
  FROM orders, (SELECT unnest(range(4)) AS c) GROUP BY c)""", select="""
SELECT chrom, chunk_id, substr(seq, (chunk_id * 1000 + 1)::INT, 1000) AS seq
FROM (SELECT chrom, seq, unnest(range((len(seq) + 999) // 1000)) AS chunk_id FROM whole)""")
define("contig_lengths", select="""
SELECT 'chr' || c AS chrom, max(o_orderkey // 32) * 224 + 7 * count(*) FILTER (last) AS length
FROM (SELECT o_orderkey, o_orderkey // 32 = (SELECT max(o_orderkey) FROM orders) // 32 AS last FROM orders),
     (SELECT unnest(range(4)) AS c) GROUP BY c""")
define("signal_text_round_trip", COUNTS, expanded("sums", "counts", 5), select=f"SELECT {RUN} FROM sums WHERE conc = 64")
define("histogram_round_trip", COUNTS, CTRL, SELF, select="""
SELECT conc, (v1 + v2 + v3)::DOUBLE AS total, round((v1 + v2 + v3) / 3.0::DOUBLE, 6) AS mean, count(*)::BIGINT AS cnt
FROM nullpk GROUP BY conc, v1 + v2 + v3""")
define("site_table_round_trip", PEAKS, select=f"SELECT conc, chrom, pos, {DOUBLES} FROM peaks")
ORACLES["count_report_round_trip"] = f"""
SELECT total_reads, passing_reads, total_sites, low_mapping_quality, above_clipping, below_ref_length, count(*)::BIGINT AS samples
FROM ({ORACLES["alignment_filter_stats"]}) GROUP BY ALL"""
define("sheet_round_trip", SHEET, select="""
SELECT sample_group, CASE sample_group WHEN 'ctrl' THEN '-' ELSE 'ctrl' END AS control_group, concentration, replicate::INT AS replicate,
       CASE sample_group WHEN 'ctrl' THEN '-' ELSE 'chr1:41,995-42,005,+' END AS on_target_location,
       'reads/' || CASE sample_group WHEN 'ctrl' THEN 'R' WHEN 'guideA' THEN 'A' ELSE 'N' END || replicate || '_2.fastq.gz' AS fastq_2
FROM samples""")
ORACLES["event_islands_stream"] = ORACLES["event_islands"]
LANES = """lanes AS (
  SELECT 'g' || (p_partkey // 8) AS sample_group, 'ctl' || (p_partkey // 8 % 20) AS control_group, 64 AS conc, p_partkey % 8 + 1 AS replicate
  FROM part WHERE p_partkey % 8 < 2 + p_partkey // 8 % 20 % 3
  UNION ALL SELECT 'ctl' || (c_custkey % 20), NULL, 0, c_custkey // 20 + 1 FROM customer WHERE c_custkey // 20 < 7)"""
define("replicate_limits", LANES, """sized AS (
  SELECT sample_group, control_group, conc, count(*) AS n FROM lanes GROUP BY ALL),
asked AS (SELECT control_group, max(n) AS most FROM sized WHERE conc > 0 GROUP BY 1)""", select="""
SELECT t.sample_group, 64 AS conc, t.sample_group || '_64nM' AS grp, c.sample_group || '_0nM' AS control_grp, t.n::INT AS n_reps,
       least(c.n, greatest(most, 2))::INT AS control_reps
FROM sized t JOIN sized c ON t.control_group = c.sample_group JOIN asked a ON a.control_group = c.sample_group WHERE t.conc > 0""")
define("run_order", LANES, select="""
SELECT sample_group || '_' || conc || 'nM_R' || replicate AS sample_id,
       row_number() OVER (ORDER BY conc > 0, sample_group, conc, replicate) AS place FROM lanes""")
