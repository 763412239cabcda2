"""Zoom levels equal direct aggregation, and a viewer's read opens few files."""

import random

import pytest

from locuswave.sinks import zoom

ROWS = "grp string, rep int, chrom string, start bigint, stop bigint, value double"


@pytest.fixture(scope="module")
def runs():
    rng, out = random.Random(4), []
    for grp in ("a", "b"):
        for chrom, length in (("chr1", 40_000), ("chr2", 900)):
            at = 0
            while at < length:
                size = rng.choice([1, 7, 90, 2000])
                if rng.random() < 0.6:
                    out.append((grp, 1, chrom, at, min(at + size, length), float(rng.randint(-4, 9))))
                at += size
    return out


def direct(runs, width):
    bins = {}
    for grp, rep, chrom, start, stop, value in runs:
        for k in range(start // width, (stop - 1) // width + 1):
            n = min(stop, (k + 1) * width) - max(start, k * width)
            low, high, total, covered = bins.get((grp, rep, chrom, k), (value, value, 0.0, 0))
            bins[grp, rep, chrom, k] = (min(low, value), max(high, value), total + n * value, covered + n)
    return sorted((g, r, c, k * width, (k + 1) * width, *v) for (g, r, c, k), v in bins.items())


def test_every_level_equals_direct_aggregation(spark, runs):
    made = zoom.pyramid(spark.createDataFrame(runs, ROWS), base=64).collect()
    levels = sorted({r.level for r in made})
    assert levels == list(range(len(levels))) and 64 * 4 ** levels[-1] >= 40_000 > 64 * 4 ** (levels[-1] - 1)
    for level in levels:
        assert sorted(tuple(r)[1:] for r in made if r.level == level) == direct(runs, 64 * 4 ** level)


def test_read_zoom_takes_one_level_and_few_files(spark, runs, tmp_path):
    path = str(tmp_path / "zoom")
    zoom.write_zoom(spark.createDataFrame(runs, ROWS), path, base=64, parts=16)
    for start, stop, bins, width in ((5_000, 9_000, 1000, 64), (5_000, 9_000, 20, 256), (0, 40_000, 3, 16384), (0, 40_000, 1, 65536)):
        got = zoom.read_zoom(spark, path, "chr1", start, stop, bins, base=64)
        want = [r for r in direct(runs, width) if r[2] == "chr1" and r[3] < stop and r[4] > start]
        columns = ["grp", "rep", "chrom", "start", "stop", "least", "greatest", "total", "covered"]
        assert sorted(map(tuple, got.select(columns).collect())) == want
    near = zoom.read_zoom(spark, path, "chr1", 5_000, 5_100, base=64)
    assert len(near.inputFiles()) <= 4 < len(spark.read.parquet(path).inputFiles())
    assert zoom.read_zoom(spark, path, "chrX", 0, 10, base=64).collect() == []
    assert zoom.pyramid(spark.createDataFrame([], ROWS)).collect() == []
