"""Connected components of a link table by alternating star operations, in Spark tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuswave.session import discard, stage


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node of ``links`` (a, b) that is not the smallest.

    Each round hangs the larger neighbours of every node, then the node itself, onto the smallest
    neighbour.  Rounds grow with the logarithm of the longest path.  Every round is a staged table, minima are
    combined map-side, and the joins with one row per node may be split by adaptive execution when a node is hot.
    """
    now = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                "links")
    mark = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == mark or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        larger = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        larger = stage(larger, "larger-star")
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        now, before = stage(smaller.filter("u <> v").distinct(), "smaller-star"), now
        discard(before, larger)
