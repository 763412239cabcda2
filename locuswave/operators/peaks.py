"""Island peak picking and the peak-value histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuswave.operators.islands import island_best
from locuswave.schema import total_of, value_names


def signal_peaks(runs: DataFrame, n: int, gap: int, tile: int = 8_192) -> DataFrame:
    """Midpoint of the highest run of each island: ``(grp, chrom, pos, v1..vn)``.

    Runs closer than ``gap`` base pairs share an island; on equal totals the later run wins.
    """
    names = value_names(n)
    best = island_best(
        runs.withColumn("run_start", F.col("start")).withColumn("run_stop", F.col("stop")),
        keys=["grp", "chrom"], gap=gap,
        priority=[total_of(n), F.col("start")],
        payload=["run_start", "run_stop", *names], tile=tile,
    )
    middle = F.expr("run_start + (run_stop - run_start) div 2")
    return best.select("grp", "chrom", middle.alias("pos"), *names)


def peak_histogram(peaks: DataFrame, n: int) -> DataFrame:
    """Peaks per total: ``(grp, total, mean, cnt)``, mean at six decimals as in the published table."""
    hist = peaks.groupBy("grp", F.round(total_of(n), 10).alias("total")).agg(F.count(F.lit(1)).alias("cnt"))
    mean = F.round((F.col("total") / F.lit(n)).cast("double"), 6)
    return hist.select("grp", "total", mean.alias("mean"), "cnt")
