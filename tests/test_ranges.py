"""Region scans of written tables open only files whose range overlaps."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from locuswave.operators.intervals import region
from locuswave.sinks import tables as sink
from locuswave.sources import ranges


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("signal") / "sums")
    runs = spark.range(6000).select(
        F.expr("cast(id % 2 * 64 as string)").alias("grp"), F.expr("concat('chr', id % 3)").alias("chrom"),
        (F.col("id") * 5).alias("start"), (F.col("id") * 5 + 7 + F.col("id") % 11).alias("stop"), F.col("id").cast("double").alias("v1"))
    sink.write_signal(runs, path, parts=24)
    return runs, path


@pytest.mark.parametrize("chrom, start, stop, grp", [
    ("chr1", 7000, 7400, None), ("chr0", None, 60, None), ("chr2", 29_900, None, "64"), ("chr1", None, None, "0"),
    ("chr1", 100, 101, "7"), ("chrX", 0, 10 ** 9, None), ("chr1", 10 ** 9, None, None)])
def test_region_equals_filter(spark, written, chrom, start, stop, grp):
    runs, path = written
    want = region(runs if grp is None else runs.filter(F.col("grp") == grp), chrom, start, stop)
    got = ranges.read_region(spark, path, chrom, start, stop, grp)
    assert dict(got.dtypes)["grp"] == "string"
    columns = ["grp", "chrom", "start", "stop", "v1"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))


def test_files_and_bytes_are_skipped(spark, written):
    _, path = written
    files = glob.glob(os.path.join(path, "grp=*", "*.parquet"))
    index = spark.read.parquet(os.path.join(path, ranges.INDEX))
    assert index.select("file").distinct().count() == len(files) > 20
    assert index.agg(F.sum("rows")).first()[0] == 6000
    sizes = {os.path.relpath(f, path): os.path.getsize(f) for f in files}
    assert {r.file: r.bytes for r in index.select("file", "bytes").distinct().collect()} == sizes
    opened = ranges.read_region(spark, path, "chr1", 7000, 7400).inputFiles()
    chosen = ranges.files_of(spark, path, "chr1", 7000, 7400).select("file", "bytes").distinct().collect()
    assert len(opened) == len(chosen) <= 4 < len(files)
    assert sum(r.bytes for r in chosen) < sum(sizes.values()) / 4
    assert ranges.read_region(spark, path, "chrX", 1, 2).collect() == []
