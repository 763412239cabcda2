"""Point-in-interval lookups and region scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuswave.schema import value_names


def lookup(points: DataFrame, runs: DataFrame, n: int, prefix: str, grp: str = "grp",
           keys: Sequence[str] = ("grp", "chrom", "pos"), bucket: int = 256, small: bool = False) -> DataFrame:
    """Left join of points with the run that covers them; values land in ``{prefix}1..n``, default 0.

    ``grp`` is the point column naming the signal table to look in.  Repeated points are looked up
    each.  Runs are disjoint, so after cutting them at bucket borders a point meets only the
    few runs of its own bucket: an equi-join, never a join on the chromosome alone.
    ``small`` says that the caller has counted the points and found them fit to broadcast; then
    the run table is not shuffled at all.
    """
    names, renamed = value_names(n), value_names(n, prefix)
    cells = F.explode(F.sequence(F.expr(f"start div {bucket}"), F.expr(f"(stop - 1) div {bucket}")))
    pieces = runs.select(
        F.col("grp").alias("_g"), F.col("chrom").alias("_c"), F.col("start").alias("_s"), F.col("stop").alias("_e"),
        *[F.col(a).alias(b) for a, b in zip(names, renamed)], cells.alias("_b"),
    )
    here = points.withColumn("_cell", F.expr(f"pos div {bucket}"))
    covered = (
        (F.col(grp) == F.col("_g")) & (F.col("chrom") == F.col("_c")) & (F.col("_cell") == F.col("_b"))
        & (F.col("_s") <= F.col("pos")) & (F.col("pos") < F.col("_e"))
    )
    if small:
        wanted = here.select(*dict.fromkeys([*keys, grp, "chrom", "pos", "_cell"])).distinct()
        hits = F.broadcast(wanted).join(pieces, covered).select(*keys, *renamed)
        joined = points.join(hits, list(keys), "left")
    else:
        joined = here.join(pieces, covered, "left").drop("_cell", "_g", "_c", "_s", "_e", "_b")
    zero = [F.coalesce(F.col(c), F.lit(0).cast(runs.schema[a].dataType)).alias(c) for a, c in zip(names, renamed)]
    return joined.select(*points.columns, *zero)


def region(runs: DataFrame, chrom: str, start: int | None = None, stop: int | None = None) -> DataFrame:
    """Runs overlapping ``[start, stop)``; an unknown contig gives no rows.

    On a table written with ``sinks.write_signal`` the filters prune row groups by min/max.
    """
    found = runs.filter(F.col("chrom") == chrom)
    if stop is not None:
        found = found.filter(F.col("start") < stop)
    if start is not None:
        found = found.filter(F.col("stop") > start)
    return found
