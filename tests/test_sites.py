import random
import re

import pytest
from pyspark.sql import functions as F

from locuswave.operators import aggregate, calling
from locuswave.params import Params
from locuswave.plans import calls, pipeline, report
from locuswave.schema import ALIGNMENTS, SAMPLE_SHEET
from locuswave.sources import tables
from tests import brute
from tests.conftest import rows

NULL = {1.0: 90, 2.0: 8, 4.0: 2}
WIDE = {1.0: 900, 6.0: 95, 30.0: 5}
P = Params(test_pval_calling_thresh=0.02, test_pval_reporting_thresh=0.1, ctrl_noise_pval_calling_thresh=0.005)


def evidence(spark, wide_value=1.0):
    run = "grp string, chrom string, start long, stop long, v1 double, v2 double"
    null = lambda values: spark.createDataFrame([("0", k, v) for k, v in values.items()], "null_id string, stat double, cnt long")
    return calling.Evidence(
        spark.createDataFrame([("64", "c", 0, 50, 7.0, 9.0)], run), spark.createDataFrame([("0", "c", 0, 50, 1.0, 1.0)], run),
        spark.createDataFrame([("0", "c", 0, 500, wide_value, wide_value)], run), null(NULL), null(WIDE), 2, 2)


def points(spark, data):
    return spark.createDataFrame([("s", 64, "64", "0", "c", pos, *v) for pos, v in data.items()],
                                 "sample_group string, conc int, grp string, control_grp string, chrom string, pos long, v1 double, v2 double")


def judge(spark, data, wide=1.0, params=P, early=True):
    return {r.pos: r for r in calling.judge(points(spark, data), evidence(spark, wide), params, early).collect()}


def test_flags_and_filters(spark):
    got = judge(spark, {10: (4.0, 4.0), 20: (3.0, 3.0), 30: (1.0, 1.0), 60: (9.0, 1.0), 70: (0.2, 0.2)})
    assert sorted(got) == [10, 20, 60]
    assert got[10].test_pval == pytest.approx(brute.p_value(NULL, 4.0)) and got[10].site_called
    assert got[20].test_pval == pytest.approx(brute.p_value(NULL, 3.0)) and not got[20].digested
    assert (got[10].t1, got[10].t2, got[60].t1, got[60].c1, got[60].w1) == (7.0, 9.0, 0.0, 0.0, 1.0)
    assert sorted(judge(spark, {30: (1.0, 1.0), 70: (0.2, 0.2)}, early=False)) == [30, 70]


def test_background_boundary(spark):
    at_threshold = judge(spark, {10: (4.0, 4.0)}, wide=30.0)[10]
    assert at_threshold.background_pval == 0.005 and at_threshold.high_background and not at_threshold.site_called
    below = 31.0
    assert judge(spark, {10: (4.0, 4.0)}, wide=below) == {}
    kept = judge(spark, {10: (4.0, 4.0)}, wide=below, params=Params(**{**P.__dict__, "include_noise_pval_fails": True}))
    assert kept[10].high_background


def test_finish(spark):
    sites = calls.without_motif(calling.judge(points(spark, {10: (4.0, 8.0), 20: (8.0, 4.0), 300: (4.0, 4.0)}), evidence(spark), P, True))
    got = {r.pos: r for r in calling.finish_sites(sites, 2, 2, P).collect()}
    assert [got[p]["rank"] for p in (10, 20, 300)] == [1, 2, 3]
    assert (got[10].pct1, got[10].pct2, got[300].mean_pct_max_peak) == (50.0, 100.0, 50.0)
    assert (got[10].total_signal, got[10].total_wide_control_reads, got[10].position_1b) == (12.0, 2.0, 11)
    compat = calling.finish_sites(sites, 2, 2, Params(**{**P.__dict__, "compat_wide_totals": True}))
    assert compat.filter("pos = 300").first().total_wide_control_reads == 0.0


def test_called_run_from_the_highest_concentration(spark):
    def tuple_of(called):
        sites = F.array(*[F.struct(F.lit(c).alias("conc"), F.lit(k).alias("site_called"), F.lit(s).alias("mean_signal"))
                          for c, k, s in zip((4, 64, 256), called, (1.0, 2.0, 3.0))])
        return spark.range(1).select(aggregate.called_signals(sites).alias("t")).first().t

    assert tuple_of((False, True, True)) == [0.0, 2.0, 3.0]
    assert tuple_of((True, False, True)) == [0.0, 0.0, 3.0]
    assert tuple_of((True, True, False)) == [0.0, 0.0, 0.0]


def test_consensus_against_a_scan(spark):
    rng = random.Random(5)
    data = sorted({(rng.choice("ab"), rng.randrange(2000)) for _ in range(250)})
    tuples = {k: (rng.random() < 0.1, [float(rng.randrange(3)), float(rng.randrange(3))], float(rng.randrange(3))) for k in data}
    frame = spark.createDataFrame([("s", c, p, *tuples[c, p]) for c, p in data],
                                  "sample_group string, chrom string, pos long, is_on_target boolean, called_signals array<double>, total_signal double")
    best, chosen, last = None, [], None
    for key in data:
        if last is None or key[0] != last[0] or last[1] + 10 < key[1]:
            chosen += [best] if best else []
            best = key
        elif tuples[key] > tuples[best]:
            best = key
        last = key
    chosen.append(best)
    for tile in (16, 8_192):
        got = aggregate.consensus(frame, Params(tile=max(tile, 302)) if tile > 300 else _tiled(tile))
        assert rows(got.select("chrom", "pos")) == sorted(chosen)
    ranked = aggregate.rank_consensus(got)
    order = sorted(chosen)
    order.sort(key=lambda k: tuples[k], reverse=True)
    first = 0 if any(tuples[k][0] for k in chosen) else 1
    assert [(r.chrom, r.pos) for r in ranked.orderBy("rank").collect()] == order and ranked.agg(F.min("rank")).first()[0] == first


def _tiled(tile):
    params = Params()
    object.__setattr__(params, "tile", tile)
    return params


@pytest.fixture(scope="module")
def run(spark):
    """Two guides' worth of reads around one strong site, noise elsewhere, on a random genome."""
    rng = random.Random(11)
    seq = "".join(rng.choice("ACGT") for _ in range(12_000))
    cut = 5_000
    motif = seq[cut - 6:cut + 5]
    location = f"chr1:{cut - 5}-{cut + 5},+"
    sheet = [("guide", "ctl", c, r, motif, location, "a.fastq.gz", "b.fastq.gz") for c in (16, 64) for r in (1, 2)]
    sheet += [("ctl", None, 0, r, None, None, "a.fastq.gz", "b.fastq.gz") for r in (1, 2, 3)]
    reads, number = [], 0
    for group, _, conc, rep, *_ in sheet:
        places = [rng.randrange(100, 11_000) for _ in range(500)]
        if conc:
            places += [cut + rng.randrange(2) for _ in range(40 * conc // 16)]
        for place in places:
            umi = "".join(rng.choice("ACGT") for _ in range(7))
            for _ in range(rng.randrange(1, 3)):  # copies
                reads.append((f"{group}_{conc}nM_R{rep}", f"r{number:06d}", "chr1", place, 0, 40, "50M", umi))
                number += 1
    params = Params(test_pval_calling_thresh=1e-2, test_pval_reporting_thresh=5e-2)
    genome = spark.createDataFrame([("chr1", i, seq[i * 1000:(i + 1) * 1000]) for i in range(12)], "chrom string, chunk_id long, seq string")
    contigs = spark.createDataFrame([("chr1", len(seq))], "chrom string, length long")
    results, stats = pipeline.analyse(
        spark.createDataFrame(sheet, SAMPLE_SHEET), spark.createDataFrame(reads, ALIGNMENTS), params, genome, 1000, contigs)
    return results, stats, params, motif, cut


def test_whole_run_finds_the_site(spark, run):
    results, stats, params, motif, cut = run
    assert [(r.n, r.m, r.concs) for r in results] == [(2, 2, [16, 64])]
    assert stats.count() == 6 + 1 and stats.filter("passing_reads <> total_reads").count() == 0
    top = results[0].sites.orderBy("rank").first()
    assert (top["rank"], top.chrom, top.is_on_target, top.closest_motif) == (0, "chr1", True, motif)
    assert abs(top.position - cut) <= 6 and top["16nM_site_called"] and top["64nM_site_called"]
    assert top["64nM_mean_signal"] > top["16nM_mean_signal"] and top["64nM_mean_pct_max_peak"] == 100.0
    assert results[0].sites.filter("is_on_target").count() == 1
    long = aggregate.unpivot_concentrations(results[0].sites)
    assert long.count() == 2 * results[0].sites.count() and {"conc", "mean_signal", "site_total_signal"} <= set(long.columns)
    grid = aggregate.complete_grid(results[0].reported, results[0].groups, results[0].tables.diffs, results[0].evidence, params)
    assert aggregate.integrity_violations(grid, 2).count() == 0
    assert grid.count() == 2 * results[0].reported.select("chrom", "pos").distinct().count()


def test_published_files(spark, run, tmp_path):
    results, stats, params, motif, _ = run
    pipeline.publish(results, stats, str(tmp_path), params=params, version="1")
    place = tmp_path / "2x2_replicates"
    page = (place / "reports" / "guide" / "report.html").read_text()
    for title in ("Metadata", "Called Site Summary", "Thresholds", "Peak Signal Distributions", "Called/Reported Sites"):
        assert title in page
    assert "<svg" in page and "Rank" in page
    ranks = []
    for shown in sorted((place / "reports" / "guide" / "sites").glob("*.html")):
        text = shown.read_text()
        ranks += [int(r) for r in re.findall(r"<tr><td>(\d+)</td>", text)]
        # Every link opens a page.
        assert all((shown.parent / link).is_file() for link in re.findall(r"href='([^']+)'", text))
    assert sorted(ranks) == sorted(r[0] for r in results[0].sites.select("rank").collect())
    links = re.findall(r"href='([^']+)'", page)
    assert links and all((place / "reports" / "guide" / link).is_file() for link in links)
    session = (tmp_path / "session.xml").read_text()
    tracks_ = re.findall(r'<Resource path="([^"]+)"', session)
    assert len(tracks_) >= 4 and all((tmp_path / t).is_file() for t in tracks_)
    metrics = "".join(p.read_text() for p in (tmp_path / "metrics").glob("*.csv")).splitlines()
    assert len(metrics) == 1 + 7 and "guide_16nM_R1" in metrics[-4] + metrics[-3] + metrics[-2] + metrics[-1]
    back = tables.read_sites(spark, str(place / "sites"), results[0].sites.schema, ("sample_group", "chrom", "position"))
    assert rows(back.select("rank", "64nM_signal_vals", "64nM_test_pval")) == rows(
        results[0].sites.select("rank", "64nM_signal_vals", "64nM_test_pval"))
    with pytest.raises(ValueError, match="twice"):
        tables.read_sites(spark, str(place / "sites"), results[0].sites.schema, ("sample_group",))
    header = next((place / "sites").glob("*.csv")).read_text().splitlines()[0]
    assert "16nM_site_called" in header and "rank" in header


def test_pages_links_and_escapes(spark, run, tmp_path):
    """Several sample groups in one write; pages link to each other and no cell is markup."""
    results, _, params, _, _ = run
    wide = results[0].sites
    nasty = "<b title='x'>&\"chr\"</b>"
    many = wide.limit(1).withColumn("rank", F.explode(F.sequence(F.lit(1), F.lit(2500)))).withColumn("chrom", F.lit(nasty))
    many = many.unionByName(many.filter("rank < 3").withColumn("sample_group", F.lit("other/group")))
    groups = spark.createDataFrame(
        [("guide", "guide_16nM", "ctl_0nM", nasty, "chr1:1-2,+"), ("other/group", "o_16nM", "ctl_0nM", None, None),
         ("without", "w_16nM", "ctl_0nM", None, None)],
        "sample_group string, grp string, control_grp string, on_target_motif string, on_target_location string")
    hist = spark.createDataFrame([("guide_16nM", 7.5, 3), ("ctl_0nM", 0.5, 9)], "grp string, mean double, cnt long")
    report.write_reports(str(tmp_path / "r"), groups, many, [16, 64], hist, None, results[0].evidence, params)
    pages = sorted((tmp_path / "r" / "guide" / "sites").glob("*.html"))
    assert len(pages) == 13
    assert sorted(p.relative_to(tmp_path / "r").as_posix() for p in (tmp_path / "r").rglob("report.html")) == [
        "guide/report.html", "other%2Fgroup/report.html", "without/report.html"]
    opened, ahead = set(), [tmp_path / "r" / "guide" / "report.html"]
    while ahead:
        at = ahead.pop().resolve()
        if at not in opened:
            opened.add(at)
            text = at.read_text()
            assert "<b" not in text.replace("<body", "").replace("<br", "") and "&lt;b title=&#x27;x&#x27;&gt;&amp;&quot;chr" in text
            ahead += [at.parent / link for link in re.findall(r"href='([^']+)'", text)]
    assert {p.name for p in opened} == {p.name for p in pages} | {"report.html"}
    assert all(p.read_text().count("href=") <= 9 for p in pages)


def test_threshold_summary(spark, run):
    results, _, params, _, _ = run
    names = {r.name: r.p for r in report.threshold_summary(results[0].evidence, params).collect()}
    assert names == {"Calling threshold": 1e-2, "Reporting threshold": 5e-2, "Background filter threshold": 5e-3}


def test_preprocess(spark):
    pairs = spark.createDataFrame([
        ("s", f"r{i}", "ACGTACGTACGT", "I" * 12, "ACGTACGTACGT", ("#" * 7 if i == 3 else "I" * 7) + "I" * 5) for i in range(10)],
        "sample_id string, read_id string, seq1 string, qual1 string, seq2 string, qual2 string")
    # Seven poor bases of twelve fail the read filter; with a laxer base rule only the UMI rule sees them.
    got = pipeline.preprocess(pairs, Params())
    assert got.reads.count() == 9 and got.read_report.first().lowq_reads == 1 and got.reads.first().umi == "ACGTACG"
    some = pipeline.preprocess(pairs, Params(subsample_fastqs=True, subsample_target_reads=4))
    assert some.read_report.first().total_reads == 4
    single = pipeline.preprocess(pairs, Params(use_umis=False))
    assert single.umi_report is None and single.reads.count() == 10
