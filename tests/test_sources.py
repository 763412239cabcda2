import gzip
import json
import random

import pytest

from locuswave.operators import groups
from locuswave.sinks import tables as sink
from locuswave.sinks import tracks
from locuswave.sources import sequences, tables
from locuswave.sinks.tables import write_fastq
from locuswave.sources.text_lines import numbered_lines
from tests.conftest import rows

SHEET = """sample_group,control_group,concentration,replicate,on_target_motif,on_target_location,fastq_1,fastq_2
g1,ctl,64,1,ACGTNGG,"chr1:1,000-1,006,+",a_1.fastq.gz,a_2.fastq.gz
g1,ctl,64,2,ACGTNGG,"chr1:1,000-1,006,+",b_1.fastq.gz,b_2.fastq.gz
ctl,,0,1,,,c_1.fastq.gz,c_2.fastq.gz
ctl,,0,2,,,d_1.fastq.gz,d_2.fastq.gz
ctl,,0,3,,,e_1.fastq.gz,e_2.fastq.gz
"""


@pytest.fixture
def tiny_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def sheet_of(spark, tmp_path, text=SHEET):
    path = tmp_path / "sheet.csv"
    path.write_text(text)
    return tables.read_sample_sheet(spark, str(path))


def test_sample_sheet(spark, tmp_path):
    sheet = groups.with_ids(sheet_of(spark, tmp_path))
    assert groups.require_valid(sheet) == ["fewer_tests_than_controls: g1_64nM"]
    limits = groups.control_limits(sheet)
    made = {r.grp: list(r.replicates) for r in groups.replicate_groups(sheet, limits).collect()}
    assert made == {"g1_64nM": [1, 2], "ctl_0nM": [1, 2]}
    pair = groups.test_control_pairs(groups.replicate_groups(sheet, limits)).first()
    assert (pair.grp, pair.control_grp, pair.n_reps, pair.control_reps) == ("g1_64nM", "ctl_0nM", 2, 2)


@pytest.mark.parametrize("old, new, rule", [
    ("g1,ctl,64,1", "g1,other,64,1", "unmatched_test_group"),
    ("g1,ctl,64,1", "g1,other,64,1", "replicate_group_fields_differ"),
    ("ctl,,0,1,,,", "ctl,x,0,1,,,", "control_fields_not_blank"),
    ("64,2,ACGTNGG", "64,2,", "test_fields_missing"),
    ("a_1.fastq.gz,a_2.fastq.gz", "a_1.fastq.gz,", "umis_need_fastq_2"),
    ("g1,ctl,64,1", "g1,ctl,-4,1", "conc_negative"),
    ("ctl,,0,2,,,d_1.fastq.gz,d_2.fastq.gz\nctl,,0,3,,,e_1.fastq.gz,e_2.fastq.gz\n", "", "control_needs_two_replicates"),
    ("ctl,,0,3,,,e_1", "spare,,0,3,,,e_1", "unused_control_group"),
    ("g1,ctl,64,2", "g1,ctl,16,1", None),
])
def test_rules(spark, tmp_path, old, new, rule):
    assert old in SHEET
    broken = groups.violations(groups.with_ids(sheet_of(spark, tmp_path, SHEET.replace(old, new))))
    found = {r.rule for r in broken.collect()}
    assert rule in found if rule else not [r for r in broken.collect() if r.severity == "error"]


def test_one_replicate_keeps_two_controls(spark, tmp_path):
    text = SHEET.replace("g1,ctl,64,2,ACGTNGG,\"chr1:1,000-1,006,+\",b_1.fastq.gz,b_2.fastq.gz\n", "")
    sheet = groups.with_ids(sheet_of(spark, tmp_path, text))
    made = {r.grp: r.n_reps for r in groups.replicate_groups(sheet, groups.control_limits(sheet)).collect()}
    assert made == {"g1_64nM": 1, "ctl_0nM": 2}


@pytest.mark.parametrize("old, new", [("64,1,", "x,1,"), ("g1,ctl", "g 1,ctl"), ("a_1.fastq.gz", "a_1.txt"), ("ACGTNGG", "ACGTXGG")])
def test_sheet_formats(spark, tmp_path, old, new):
    with pytest.raises(Exception, match="bad"):
        sheet_of(spark, tmp_path, SHEET.replace(old, new)).collect()


def test_keyed_join_checks(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string")
    b = spark.createDataFrame([(1, "p"), (2, "q")], "k int, b string")
    assert rows(groups.keyed_join(a, b, ["k"])) == [(1, "x", "p"), (2, "y", "q")]
    with pytest.raises(Exception, match="without partner"):
        groups.keyed_join(a, b.limit(1), ["k"]).collect()
    with pytest.raises(Exception, match="duplicate key"):
        groups.keyed_join(a.union(a), b, ["k"]).collect()


def test_line_numbers_over_splits(spark, tmp_path, tiny_splits):
    path = tmp_path / "lines.txt"
    path.write_text("".join(f"line {i}\n" for i in range(300)))
    got = numbered_lines(spark, [str(path)])
    assert got.select("split").distinct().count() > 3
    assert [(r.line_no, r.line) for r in got.orderBy("line_no").collect()] == [(i, f"line {i}") for i in range(300)]


def test_fastq_pairs_and_lanes(spark, tmp_path, tiny_splits):
    def write(name, ids, opener):
        with opener(tmp_path / name, "wt") as out:
            out.writelines(f"@{i} x\nACGT{i}\n+\nIIII{'#' * len(str(i))}\n" for i in ids)
        return str(tmp_path / name)

    sheet = spark.createDataFrame([
        ("s", write("a_1.fastq", range(40), open), write("a_2.fastq", range(30), open)),
        ("s", write("b_1.fastq.gz", range(100, 105), gzip.open), write("b_2.fastq.gz", range(100, 105), gzip.open)),
        ("t", write("c_1.fastq", range(7), open), None)], "sample_id string, fastq_1 string, fastq_2 string")
    got = sequences.read_fastq(spark, sheet)
    assert {r.sample_id: r["count"] for r in got.groupBy("sample_id").count().collect()} == {"s": 35, "t": 7}
    row = got.filter("sample_id = 's' and read_id = '17'").first()
    assert (row.seq1, row.qual1, row.seq2) == ("ACGT17", "IIII##", "ACGT17")
    assert got.filter("sample_id = 't' and seq2 is not null").count() == 0

    sink.write_fastq(got.filter("sample_id = 's'"), str(tmp_path / "out"))
    written = "".join(gzip.open(p, "rt").read() for p in sorted((tmp_path / "out" / "sample_id=s" / "mate=2").glob("*.gz")))
    assert written.count("@") == 35 and written.startswith("@0\nACGT0\n+\nIIII#\n")


def test_sam(spark, tmp_path):
    path = tmp_path / "x.sam"
    path.write_text("@SQ\tSN:chr1\tLN:1000\nr1_ACGTACG\t16\tchr1\t101\t40\t50M\t*\t0\t0\tA\tI\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI\n")
    got = sequences.read_sam(spark, "s", str(path)).orderBy("read_id").collect()
    assert tuple(got[0]) == ("s", "r1_ACGTACG", "chr1", 100, 16, 40, "50M", "ACGTACG")
    assert got[1].chrom is None and got[1].umi is None


def test_fasta_over_splits(spark, tmp_path, tiny_splits):
    rng = random.Random(1)
    genome = {f"chr{i}": "".join(rng.choice("ACGT") for _ in range(n)) for i, n in enumerate((900, 37, 2500, 1))}
    path = tmp_path / "g.fa"
    path.write_text("".join(f">{k} note\n" + "".join(s[i:i + 60] + "\n" for i in range(0, len(s), 60)) for k, s in genome.items()))
    got = sequences.read_fasta(spark, str(path), chunk=100)
    seqs = {}
    for r in got.orderBy("chrom", "chunk_id").collect():
        seqs[r.chrom] = seqs.get(r.chrom, "") + r.seq
    assert seqs == genome
    assert {r.chrom: r.length for r in sequences.contigs_of(got, 100).collect()} == {k: len(s) for k, s in genome.items()}
    (tmp_path / "g.fa.fai").write_text("chr0\t900\t6\t60\t61\n")
    assert tuple(sequences.read_fai(spark, str(tmp_path / "g.fa.fai")).first()) == ("chr0", 900)


def test_signal_text_round_trip(spark, tmp_path):
    runs = spark.createDataFrame([("g", "chr1", 3, 9, 1.5, 0.0), ("g", "chr10", 1, 2, 0.0, 2.25)],
                                 "grp string, chrom string, start long, stop long, v1 double, v2 double")
    sink.write_signal_text(runs, ["A_R1", "A_R2"], str(tmp_path / "sig"))
    assert tables.header_of(spark, str(tmp_path / "sig"))[3:] == ["A_R1", "A_R2"]
    assert rows(tables.read_signal(spark, str(tmp_path / "sig"), "g")) == rows(runs)
    short = tmp_path / "short.tsv"
    short.write_text("#chromosome\tstart\tend\ta\tb\nchr1\t1\t2\t3.0\n")
    with pytest.raises(Exception):
        tables.read_signal(spark, str(short), "g").collect()
    sink.write_signal(runs, str(tmp_path / "pq"))
    plan = spark.read.parquet(str(tmp_path / "pq")).filter("chrom = 'chr1' and start < 5 and stop > 4")
    assert "LessThan(start,5)" in plan._jdf.queryExecution().executedPlan().toString() and plan.count() == 1


def test_histogram_round_trip(spark, tmp_path):
    hist = spark.createDataFrame([("g", 3.0, 1.0, 7), ("g", 9.0, 3.0, 2)], "grp string, total double, mean double, cnt long")
    sink.write_histogram(hist, str(tmp_path / "h"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "h" / "grp=g").glob("*.csv")))
    assert text.splitlines()[0] == "sum\tmean\tcount" and text.index("9.0") < text.index("3.0\t1.0")
    assert rows(tables.read_histogram(spark, str(tmp_path / "h" / "grp=g"), "g")) == rows(hist)


def test_tool_reports(spark, tmp_path):
    (tmp_path / "f.json").write_text(json.dumps({
        "summary": {"before_filtering": {"total_reads": 200, "q30_rate": 0.9}},
        "filtering_result": {"passed_filter_reads": 180, "low_quality_reads": 10, "too_many_N_reads": 4, "too_short_reads": 6}}, indent=1))
    got = tables.read_filter_report(spark, str(tmp_path / "f.json")).first()
    assert (got.total_reads, got.lowq_reads, got.reads_passing_filter, got.pct_q30_reads_pf) == (100, 5, 90, 90.0)
    assert tables.read_filter_report(spark, str(tmp_path / "f.json"), paired=False).first().total_reads == 200
    (tmp_path / "c.json").write_text(json.dumps({
        "total_reads": 9, "passing_reads": 4, "total_sites": 3,
        "filters": {"low_mapping_quality": 1, "above_clipping": 2, "below_ref_length": 3}}))
    assert tables.read_count_report(spark, str(tmp_path / "c.json")).first().above_clipping == 2
    (tmp_path / "b.log").write_text("100 reads; of these:\n  100 (100.00%) were unpaired; of these:\n    12 (12.00%) aligned 0 times\n")
    assert tables.read_aligner_log(spark, str(tmp_path / "b.log")).first().aligned_reads == 88
    (tmp_path / "d.log").write_text("INFO Reads: Input Reads: 80\nINFO Number of reads out: 60\n")
    assert tables.read_dedup_log(spark, str(tmp_path / "d.log")).first().pct_duplication == 25.0
    (tmp_path / "e.log").write_text("nothing\n")
    for read in (tables.read_dedup_log, tables.read_aligner_log):
        with pytest.raises(Exception, match="no .* summary"):
            read(spark, str(tmp_path / "e.log")).collect()


def test_tracks(spark, tmp_path):
    runs = spark.createDataFrame([("g", "c", 1, 2, 0.0, 2.0), ("g", "c", 4, 6, 0.0, 1.0)],
                                 "grp string, chrom string, start long, stop long, v1 double, v2 double")
    tracks.write_bedgraph(runs, [1, 2], str(tmp_path / "t"))
    assert [p.name for p in (tmp_path / "t" / "grp=g").iterdir() if p.is_dir()] == ["rep=2"]
    xml = tracks.browser_session("hg38", [["/d/a.bam"], ["/d/a.bw", "/d/b.bw"]])
    assert xml.count("<Panel") == 3 and xml.count("<Resource ") == 3 and "CoverageTrack" in xml
    with pytest.raises(ValueError):
        tracks.browser_session("hg38", [["x.vcf"]])
    assert tracks.track_path("a.bw", "/data/run", "/data/igv", relative=True) == "../run/a.bw"
    assert tracks.track_path("a.bw", "/data/run", "/x", "http://h", ["/data"]) == "http://h/run/a.bw"
    assert tracks.track_path("a.bw", "/data/run", "/x", "http://h", " /x, /data ,") == "http://h/run/a.bw"
    assert tracks.track_path("a.bw", "/data/run", "/x", "http://h") == "http://h/data/run/a.bw"


def test_lines_survive_another_cut_into_splits(spark, tmp_path):
    path = tmp_path / "many.txt"
    path.write_text("".join(f"line {k}\n" for k in range(50_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    lines = numbered_lines(spark, [str(path)])
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        got = {r.line_no: r.line for r in lines.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {k: f"line {k}" for k in range(50_000)}


def test_umi_goes_through_fastq_and_sam(spark, tmp_path):
    pairs = spark.createDataFrame([("s", "r1", "ACGT", "IIII", "GGTTA")], "sample_id string, read_id string, seq1 string, qual1 string, umi string")
    write_fastq(pairs, str(tmp_path / "fq"))
    name = spark.read.text(str(tmp_path / "fq")).first().value.split("\n")[0][1:]
    (tmp_path / "a.sam").write_text(f"{name}\t0\tc\t5\t9\t4M\t*\t0\t0\tACGT\tIIII\n")
    row, = sequences.read_sam(spark, "s", str(tmp_path / "a.sam")).collect()
    assert name == "r1_GGTTA" and row.umi == "GGTTA"
