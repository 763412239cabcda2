import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from locuswave.operators import intervals, islands, peaks, signal
from locuswave.schema import devectorize, vectorize
from tests import brute
from tests.conftest import rows


def counts_of(spark, data, n, kind="long"):
    columns = ", ".join(f"v{k} {kind}" for k in range(1, n + 1))
    return spark.createDataFrame([(*k, *v) for k, v in data.items()], f"grp string, chrom string, pos long, {columns}")


def random_counts(seed, grps=("a",), n=3, size=400, reach=3000):
    rng = random.Random(seed)
    data = {}
    for _ in range(size):
        key = (rng.choice(grps), rng.choice(["chr1", "chr10", "chr2"]), rng.randrange(reach))
        data[key] = tuple(rng.randrange(3) for _ in range(n))
    return {k: v for k, v in data.items() if sum(v)}


def test_sum_clipped_at_both_ends(spark):
    counts = counts_of(spark, {("g", "chrA", 1): (1,), ("g", "chrA", 5): (2,), ("g", "chrA", 28): (3,)}, 1)
    contigs = spark.createDataFrame([("chrA", 30)], "chrom string, length long")
    sums = signal.window_sums(counts, 1, 2, tile=8, contigs=contigs)
    assert [r[2:] for r in rows(sums)] == [(0, 3, 1), (3, 4, 3), (4, 8, 2), (26, 30, 3)]
    hist = signal.value_histogram(sums, 1)
    assert {(r.mean, r.cnt) for r in hist.collect()} == {(3.0, 5), (2.0, 4), (1.0, 3)}


def test_unknown_contig_fails(spark):
    counts = counts_of(spark, {("g", "chrB", 1): (1,)}, 1)
    contigs = spark.createDataFrame([("chrA", 30)], "chrom string, length long")
    with pytest.raises(Exception, match="contig not in the genome index"):
        signal.window_sums(counts, 1, 2, contigs=contigs).collect()


def test_difference_clips_per_replicate(spark):
    test = counts_of(spark, {("g", "c", 10): (4, 1)}, 2)
    control = counts_of(spark, {("g", "c", 12): (1, 3)}, 2)
    assert [r[2:] for r in rows(signal.window_diffs(test, control, 2, 2))] == [(8, 10, 4, 1), (10, 13, 3, 0)]


def test_self_difference_rotates(spark):
    control = counts_of(spark, {("g", "c", 10): (5, 2, 0)}, 3)
    assert [r[2:] for r in rows(signal.self_diffs(control, 3, 2))] == [(8, 13, 3, 2, 0)]
    assert rows(signal.rotate(control, 3).select("v1", "v2", "v3")) == [(2, 0, 5)]
    with pytest.raises(ValueError):
        signal.self_diffs(control, 1, 2)


def test_tasks_grow_with_the_positions(spark, monkeypatch):
    """Adaptive execution would put these few bytes into at most four tasks."""
    data = random_counts(8, grps=("a", "b"), size=600)
    counts = counts_of(spark, data, 3)
    whole = rows(signal.window_sums(counts, 3, 5, tile=32))
    monkeypatch.setattr(signal, "TASK_ROWS", len(data) // 12)
    sums = signal.window_sums(counts, 3, 5, tile=32)
    assert rows(sums) == whole
    assert len(sums.inputFiles()) >= 10


@pytest.mark.parametrize("tile", [16, 100, 65_536])
@pytest.mark.parametrize("w", [0, 5])
def test_sums_against_expansion(spark, w, tile):
    data = random_counts(w + 1)
    sums = signal.window_sums(counts_of(spark, data, 3), 3, w, tile=tile)
    assert rows(sums) == sorted(brute.runs(brute.window_values(data, w, 3)))


def test_run_longer_than_many_tiles(spark):
    data = {("g", "c", p): (1,) for p in range(500)}
    sums = signal.window_sums(counts_of(spark, data, 1), 1, 5, tile=16)
    assert rows(sums) == sorted(brute.runs(brute.window_values(data, 5, 1)))


@pytest.mark.parametrize("tile", [16, 64, 65_536])
def test_differences_and_peaks_against_expansion(spark, tile):
    test, control = random_counts(7), random_counts(8)
    got = signal.window_diffs(counts_of(spark, test, 3), counts_of(spark, control, 3), 3, 5, tile=tile)
    at = brute.window_values(test, 5, 3)
    for key, values in brute.window_values(control, 5, 3).items():
        at[key] = [a - b for a, b in zip(at[key], values)]
    expected = brute.runs(at)
    assert rows(got) == sorted(expected)
    for gap in (0, 5, 40):
        assert rows(peaks.signal_peaks(got, 3, gap, tile=tile)) == brute.peaks(expected, gap)


def test_peak_ties_take_the_later_run(spark):
    runs = spark.createDataFrame(
        [("g", "c", 8, 10, 5), ("g", "c", 10, 13, 3), ("g", "c", 18, 20, 5), ("g", "c", 26, 27, 1)],
        "grp string, chrom string, start long, stop long, v1 long")
    for tile in (4, 10, 1000):
        assert [r[2:] for r in rows(peaks.signal_peaks(runs, 1, 5, tile=tile))] == [(19, 5), (26, 1)]


def test_mass_is_kept_away_from_the_ends(spark):
    data = {k: v for k, v in random_counts(3).items() if k[2] >= 5}
    sums = signal.window_sums(counts_of(spark, data, 3), 3, 5, tile=64)
    total = sums.agg(F.sum((F.col("stop") - F.col("start")) * (F.col("v1") + F.col("v2") + F.col("v3")))).first()[0]
    assert total == 11 * sum(sum(v) for v in data.values())


def test_decimals_stay_exact(spark):
    third = Decimal("0.3333333333")
    data = {("g", "c", p): (third,) for p in range(0, 300, 3)}
    sums = signal.window_sums(counts_of(spark, data, 1, "decimal(28,10)"), 1, 5, tile=32)
    assert rows(sums) == sorted(brute.runs(brute.window_values(data, 5, 1)))


def test_half_of_all_rows_on_one_chromosome_needs_many_tasks(spark):
    counts = spark.range(20_000).select(
        F.lit("g").alias("grp"), F.lit("chr1").alias("chrom"), (F.col("id") * 7).alias("pos"), F.lit(1).cast("long").alias("v1"))
    placed = signal._spans(counts, 5, None).withColumn("tile", F.expr("_lo div 4096"))
    assert placed.groupBy("tile").count().agg(F.max("count")).first()[0] < 4096
    assert signal.window_sums(counts, 1, 5, tile=4096).count() == signal.window_sums(counts, 1, 5).count()


def test_islands_on_points(spark):
    points = spark.createDataFrame([("g", 100, 1), ("g", 110, 1), ("g", 121, 2)], "k string, pos long, v long")
    for tile in (1, 16, 1000):
        best = islands.island_best(points, ["k"], 10, [F.col("v"), -F.col("pos")], ["pos"], "pos", "pos", tile)
        assert rows(best.select("pos", "members")) == [(100, 2), (121, 1)]


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("bucket", [4, 256])
def test_lookup_against_scan(spark, bucket, small):
    data = random_counts(5)
    found = brute.runs(brute.window_values(data, 20, 3))
    runs = spark.createDataFrame(found, "grp string, chrom string, start long, stop long, v1 long, v2 long, v3 long")
    rng = random.Random(1)
    points = [("a", rng.choice(["chr1", "chr2", "chrX"]), p) for p in range(0, 3200, 7)]
    got = intervals.lookup(spark.createDataFrame(points, "grp string, chrom string, pos long"), runs, 3, "w",
                           bucket=bucket, small=small)

    def scan(point):
        hit = [r[4:] for r in found if r[:2] == point[:2] and r[2] <= point[2] < r[3]]
        return (*point, *(hit[0] if hit else (0, 0, 0)))

    assert rows(got) == sorted(scan(p) for p in points)


def test_region(spark):
    runs = spark.createDataFrame([("g", "c", 0, 5, 1.0), ("g", "c", 5, 9, 2.0), ("g", "d", 5, 9, 3.0)],
                                 "grp string, chrom string, start long, stop long, v1 double")
    assert [r.v1 for r in intervals.region(runs, "c", 5, 6).collect()] == [2.0]
    assert intervals.region(runs, "zz").count() == 0


def test_vector_form_round_trip(spark):
    runs = spark.createDataFrame([("g", 1, 1.0, 2.0)], "grp string, start long, v1 double, v2 double")
    packed = vectorize(runs, 2)
    assert packed.first().vals == [1.0, 2.0]
    assert rows(devectorize(packed, 2)) == rows(runs)


def test_window_shuffles_once_per_position(spark):
    counts = counts_of(spark, random_counts(2), 3)
    steps = signal._spans(counts, 5, None)
    plan = steps._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "BroadcastNestedLoop" not in plan
