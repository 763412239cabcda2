import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from locuswave.functions import coords, display, dna
from locuswave.functions.coords import Span
from locuswave.operators import motif
from locuswave.params import Params
from tests import brute


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def span(text, one_based=True):
    return Span.parse(F.lit(text), one_based)


def test_text_and_kinds(spark):
    a, b = span("chr1:10-20,+"), span("chr1:20-30,-")
    got = one(spark, a.intersection(b, ignore_strand=True).alias("i"), a.overlaps(b).alias("o"),
              a.to_zero_based().text().alias("z"), span("chr1:1,234-2,000,-").text().alias("t"), span("chr1:7").text().alias("p"))
    assert (got.i.start, got.i.stop, got.i.is_reverse_strand, got.o) == (20, 20, False, False)
    assert (got.z, got.t, got.p) == ("chr1:9_20,+", "chr1:1234-2000,-", "chr1:7-7,+")
    zero = one(spark, span("chr1:10_20", False).overlaps(span("chr1:20_30", False)).alias("o"))
    assert not zero.o


def test_changes(spark):
    f, r = span("c:10-20,+"), span("c:10-20,-")
    cases = [
        (f.extend_5prime(F.lit(3)), "c:7-20,+"), (r.extend_5prime(F.lit(3)), "c:10-23,-"),
        (f.extend_3prime(F.lit(3)), "c:10-23,+"), (r.extend_3prime(F.lit(3)), "c:7-20,-"),
        (f.clip_5prime(F.lit(3)), "c:13-20,+"), (r.clip_5prime(F.lit(3)), "c:10-17,-"),
        (f.clip_3prime(F.lit(3)), "c:10-17,+"), (r.clip_3prime(F.lit(3)), "c:13-20,-"), (f.switch_strand(), "c:10-20,-"),
    ]
    got = one(spark, *[c.text().alias(f"x{i}") for i, (c, _) in enumerate(cases)])
    assert list(got) == [text for _, text in cases]
    with pytest.raises(Exception, match="cannot clip"):
        one(spark, f.clip_5prime(F.lit(11)).text().alias("x"))
    with pytest.raises(Exception, match="larger than"):
        one(spark, span("c:20-10,+").text().alias("x"))
    assert one(spark, span("c:20-10,-").text().alias("x")).x == "c:10-20,-"
    with pytest.raises(Exception, match="1-based"):
        one(spark, span("c:5_5", False).to_one_based().text().alias("x"))


def test_difference_and_sides(spark):
    a = span("c:10-20,+")
    parts = lambda other: [(p.start, p.stop) for p in one(spark, a.difference(span(other)).alias("d")).d]
    assert parts("c:13-15,+") == [(10, 12), (16, 20)]
    assert parts("c:1-30,+") == [] and parts("c:40-50,+") == [(10, 20)] and parts("c:13-15,-") == [(10, 20)]
    got = one(spark, a.is_5prime_of(span("c:21-30,+")).alias("a"), a.is_5prime_of(span("c:20-30,+")).alias("b"),
              span("c:21-30,-").is_5prime_of(span("c:10-20,-")).alias("c"), a.is_3prime_of(span("c:1-9,+")).alias("d"),
              span("c:10_20", False).is_5prime_of(span("c:20_30", False)).alias("e"))
    assert list(got) == [True, False, True, True, True]


def test_on_target_needs_more_than_the_share(spark):
    target = "chr1:100-122,+"
    hit = lambda m: one(spark, coords.on_target(F.lit(m), F.lit(target)).alias("h")).h
    assert hit("chr1:102-130,-") and not hit("chr1:103-130,-") and not hit("chr2:100-122,+")


def test_combine(spark):
    df = spark.range(1).select(F.explode(F.array(span("c:5-9,-").pack(), span("c:1-3,+").pack())).alias("span"), F.lit(1).alias("k"))
    assert coords.combine(df, ["k"]).select("span.start", "span.stop", "span.is_reverse_strand").first() == (1, 9, False)
    with pytest.raises(Exception, match="at least two"):
        coords.combine(df.limit(1), ["k"]).collect()


def test_reverse_complement(spark):
    got = one(spark, dna.reverse_complement(F.lit("ACGTNRYSWKMBVDH-")).alias("r")).r
    assert got == "-DHBVKMWSRYNACGT" and dna.reverse_complement_text("ACGTNRYSWKMBVDH-") == got
    with pytest.raises(Exception, match="nucleotide"):
        one(spark, dna.reverse_complement(F.lit("AXQ")).alias("r"))


def test_display(spark):
    got = one(spark, display.integer(F.lit(1234567)).alias("a"), display.decimal(F.lit(1234.567)).alias("b"),
              display.p_value(F.lit(0.000123)).alias("c"), display.percentage(F.lit(12.345)).alias("d"),
              display.number_list(F.array(F.lit(1.0), F.lit(2000.5))).alias("e"),
              display.coordinate(F.lit("chr1:1234-5678,-")).alias("f"), display.dna_html(F.lit("Ag")).alias("g"))
    assert list(got)[:6] == ["1,234,567", "1,234.57", "1.230e-04", "12.35%", "1.00; 2,000.50", "chr1:1,234-5,678,-"]
    assert got.g.count("<span") == 3 and "#008000" in got.g


def align(motif_, windows, match=1, mismatch=1, gap=8):
    return motif.align_batch(pd.Series([motif_] * len(windows)), pd.Series(windows), match, mismatch, gap)


def test_motif_exact_reverse_and_gapped():
    got = align("ACGTNGG", ["TTACGTAGGTT", "CCTACGTCCCC"])
    assert list(got["sequence"]) == ["ACGTAGG", "ACGTAGG"] and list(got["score"]) == [7, 7]
    assert list(got["is_reverse"]) == [False, True] and list(got["begin"]) == [2, 0] and list(got["finish"]) == [9, 7]
    extra = align("AAAACCCC", ["GGAAAATCCCCGG"], match=2, mismatch=2, gap=3).iloc[0]
    assert (extra["sequence"], extra["gaps"], extra["score"]) == ("AAAAtCCCC", 1, 13)
    missing = align("AAAATCCCC", ["GGAAAACCCCGG"], match=2, mismatch=2, gap=3).iloc[0]
    assert (missing["sequence"], missing["gaps"], missing["score"]) == ("AAAA-CCCC", 1, 13)


def test_motif_scores_against_plain_table():
    rng = random.Random(9)
    windows = ["".join(rng.choice("ACGT") for _ in range(rng.choice([18, 24]))) for _ in range(60)] + ["", None]
    for match, mismatch, gap in ((1, 1, 8), (3, 2, 2)):
        got = align("GATNRCA", windows, match, mismatch, gap)
        for window, row in zip(windows, got.itertuples()):
            if not window:
                assert pd.isna(row.score)
                continue
            best = max(brute.alignment_score(m, window, match, mismatch, gap, dna.base_mask)
                       for m in ("GATNRCA", dna.reverse_complement_text("GATNRCA")))
            assert row.score == best
            text = row.sequence.replace("-", "")
            shown = dna.reverse_complement_text(window[row.begin:row.finish]) if row.is_reverse else window[row.begin:row.finish]
            assert text.upper() == shown


def test_windows_from_chunks(spark):
    rng = random.Random(3)
    seq = "".join(rng.choice("ACGT") for _ in range(95))
    genome = spark.createDataFrame([("c", i, seq[i * 10:(i + 1) * 10]) for i in range(10)], "chrom string, chunk_id long, seq string")
    sites = spark.createDataFrame([("c", p) for p in (2, 40, 93)], "chrom string, pos long")
    got = {r.pos: (r.window_start, r.window) for r in motif.site_windows(sites, genome, 12, 10).collect()}
    assert got == {p: (max(p - 12, 0), seq[max(p - 12, 0):p + 12]) for p in (2, 40, 93)}
    found = motif.find_motif(motif.site_windows(sites, genome, 12, 10).withColumn("on_target_motif", F.lit(seq[35:46])), Params())
    row = found.filter("pos = 40").first()
    assert (row.motif_location, row.motif_score, row.num_subs) == ("c:36-46,+", 11, 0)


def test_site_windows_have_their_own_width(spark):
    genome = spark.createDataFrame([("c", 0, "ACGTACGTAC"), ("c", 1, "GTTTTTACGT")], "chrom string, chunk_id long, seq string")
    sites = spark.createDataFrame([("c", 10, 2), ("c", 10, 6), ("c", 3, None)], "chrom string, pos long, w int")
    got = {r.w: (r.window_start, r.window) for r in motif.site_windows(sites, genome, F.col("w"), 10).collect()}
    assert got == {2: (8, "ACGT"), 6: (4, "ACGTACGTTTTT"), None: (3, "")}
