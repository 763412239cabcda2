import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from locuswave.functions import dna
from locuswave.operators import dedup, qc, reads, sampling
from locuswave.params import Params
from locuswave.schema import ALIGNMENTS
from tests import brute
from tests.conftest import rows

P = Params()
M6 = [
    (0, 100, 40, "50M"), (16, 100, 40, "50M"), (16, 100, 40, "5S45M"), (0, 100, 40, "5S45M"), (16, 100, 40, "45M5S"),
    (0, 100, 3, "10M"), (0, 100, 40, "10M5I5D10M"), (4, 100, 40, "50M"), (256, 100, 40, "50M"), (2048, 100, 40, "50M"),
]


def alignments(spark, data):
    return spark.createDataFrame(
        [("s", f"r{i}", "chr1", pos, flag, mapq, cigar, "AAAAAAA") for i, (flag, pos, mapq, cigar) in enumerate(data)],
        ALIGNMENTS)


def test_filters_and_counts(spark):
    classified = reads.classify(alignments(spark, M6), P)
    counts = reads.read_start_counts(classified)
    assert rows(counts.select("pos", "n")) == [(100, 2), (144, 1), (149, 1)]
    stats = reads.count_stats(classified).first()
    assert (stats.total_reads, stats.passing_reads, stats.total_sites) == (7, 4, 3)
    assert (stats.low_mapping_quality, stats.above_clipping, stats.below_ref_length) == (1, 2, 1)
    scaled = {r.pos: r.n for r in reads.per_million(counts, stats_frame(spark)).collect()}
    assert float(scaled[100]) == pytest.approx(285714.2857142857)


def stats_frame(spark):
    return spark.createDataFrame([("s", 7)], "sample_id string, total_reads long")


def test_merge_is_an_outer_join(spark):
    counts = spark.createDataFrame([("g", "c", 1, 1, 5), ("g", "c", 1, 3, 2), ("g", "c", 9, 2, 1)],
                                   "grp string, chrom string, pos long, rep int, n long")
    assert rows(reads.merge_replicates(counts, [1, 2, 3])) == [("g", "c", 1, 5, 0, 2), ("g", "c", 9, 0, 1, 0)]


def test_umi_rule(spark):
    quals = ["IIIIIII", "#IIIIII", "##IIIII", "", "#####", "II"]
    df = spark.createDataFrame([(q,) for q in quals], "q string")
    got = [r.ok for r in df.select(dna.umi_passes(F.col("q"), 7, 20, 1).alias("ok")).collect()]
    assert got == [True, True, False, False, False, True]


def test_params_are_checked():
    with pytest.raises(ValueError):
        Params(umi_length=0)
    with pytest.raises(ValueError):
        Params(subsample_fastqs=True)
    with pytest.raises(ValueError):
        Params.from_dict({"no_such": 1})


def test_read_flags_and_reports(spark):
    pairs = spark.createDataFrame([
        ("s", "a", "ACGTACGT", "IIIIIIII", "ACGTACGTAC", "IIIIIIIIII"), ("s", "b", "ACGTACGT", "!!!!IIII", "ACGTACGTAC", "IIIIIIIIII"),
        ("s", "c", "NNNNNNGT", "IIIIIIII", "ACGTACGTAC", "IIIIIIIIII"), ("s", "d", "ACG", "III", "ACGTACGTAC", "IIIIIIIIII"),
        ("s", "e", "ACGTACGT", "IIIIIIII", "ACGTACGTAC", "##IIIIIIII")],
        "sample_id string, read_id string, seq1 string, qual1 string, seq2 string, qual2 string")
    flagged = qc.umi_flags(qc.read_flags(pairs, P), P)
    r = qc.read_report(flagged).first()
    assert (r.total_reads, r.lowq_reads, r.too_many_n_reads, r.short_reads, r.reads_passing_filter) == (5, 1, 1, 1, 2)
    kept = qc.extract_umi(flagged.filter("read_ok and umi_ok"), P)
    assert [(x.read_id, x.umi) for x in kept.collect()] == [("a", "ACGTACG")]
    assert "seq2" not in kept.columns


def test_exact_dedup_keeps_the_best_copy(spark):
    data = alignments(spark, [(0, 10, 5, "50M"), (0, 10, 30, "50M"), (0, 12, 20, "2S48M"), (16, 10, 9, "50M")])
    assert [r.read_id for r in dedup.exact_umi(data).orderBy("read_id").collect()] == ["r1", "r3"]


def test_directional_dedup_against_all_pairs(spark):
    rng = random.Random(2)
    umis = [("".join(rng.choice("ACGT") for _ in range(3))) for _ in range(25)]
    data, copies = [], {p: Counter() for p in (10, 500)}
    for i in range(600):
        pos, umi = rng.choice([10, 500]), rng.choice(umis[: rng.randrange(1, 26)])
        copies[pos][umi] += 1
        data.append(("s", f"r{i:04d}", "chr1", pos, 0, rng.randrange(40), "50M", umi))
    got = dedup.directional_umi(spark.createDataFrame(data, ALIGNMENTS)).collect()
    for pos, counts in copies.items():
        owner = brute.umi_clusters(counts)
        best = {}
        for row in data:
            if row[3] == pos and owner[row[7]] == row[7]:  # reads of absorbed UMIs never stand for the molecule
                key = row[7]
                best[key] = min(best.get(key, (1, "")), (-row[5], row[1]))
        assert sorted(r.read_id for r in got if r.pos == pos) == sorted(b[1] for b in best.values())


def test_subsample_is_exact_and_repeatable(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 50, F.lit("few")).otherwise(F.lit("hot")).alias("sample_id"),
                                  F.col("id").cast("string").alias("read_id"))
    once, again = (sampling.subsample(df, 200, seed=100) for _ in range(2))
    assert rows(once) == rows(again)
    assert {r.sample_id: r["count"] for r in once.groupBy("sample_id").count().collect()} == {"few": 50, "hot": 200}
    assert rows(once) != rows(sampling.subsample(df, 200, seed=7))


def test_missing_umi_raises(spark):
    data = spark.createDataFrame([("s", "r1", "chr1", 5, 0, 9, "50M", None), ("s", "r2", "chr1", 5, 0, 9, "50M", "AC")], ALIGNMENTS)
    for operator in (dedup.exact_umi, dedup.directional_umi):
        with pytest.raises(Exception, match="without a UMI"):
            operator(data).collect()


def test_absorbed_umi_does_not_win(spark):
    data = [("s", f"r{k}", "chr1", 5, 0, 20, "50M", "AAAAAAA") for k in range(9)] + [("s", "error", "chr1", 5, 0, 40, "50M", "AAAAAAC")]
    kept = dedup.directional_umi(spark.createDataFrame(data, ALIGNMENTS)).collect()
    assert [(r.read_id, r.umi) for r in kept] == [("r0", "AAAAAAA")]


def test_dedup_keeps_other_columns_and_hot_molecules(spark):
    """Alignments with more columns are fetched whole; one molecule holds most rows, one row is there twice."""
    data = [("s", f"r{i:04d}", "chr1", 100, 0, 10 + i % 7, "50M", "ACGT") for i in range(500)]
    data += [("s", "t", "chr1", 300, 0, 40, "50M", "TTTT")] * 2 + [("s", "u", "chr1", 300, 0, 40, "50M", "GGGG")]
    frame = spark.createDataFrame(data, ALIGNMENTS)
    for operator in (dedup.exact_umi, dedup.directional_umi):
        plain = rows(operator(frame))
        wide = operator(frame.withColumn("note", F.concat(F.lit("n"), "read_id")).withColumn("bases", F.array("mapq")))
        assert wide.columns == [*frame.columns, "note", "bases"] and {r.note for r in wide.collect()} == {"nr0006", "nt", "nu"}
        assert rows(wide.select(*frame.columns)) == plain and len(plain) == 3
