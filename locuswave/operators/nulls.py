"""Empirical null distributions: survival p-values and their inverse.

The axis of distinct values is cut into ranges, so that neither the running counts nor the
neighbour search of one null ever sits in a single task.  Ranges exchange only one summary row
each.  Range borders grow with the square root of the value: with values rounded to six decimals a
range around x holds at most ``1e6 * sqrt(x) / 32`` distinct values, and a null whose greatest
value is x has at most ``64 * sqrt(x)`` ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuswave.session import stage

STAT_DIGITS = 6
P_DIGITS = 16
RANGES_PER_ROOT = 64


def null_from_histogram(hist: DataFrame, stat: str = "mean", overwrite: bool = False,
                        digits: int = STAT_DIGITS) -> DataFrame:
    """``(null_id, stat, cnt)`` from a value histogram; values equal after rounding are added.

    ``overwrite`` keeps, for equal values, only the count that comes last in the published table
    (smallest total) instead of the sum.
    """
    keyed = hist.select(F.col("grp").alias("null_id"), rounded(F.col(stat), digits).alias("stat"), "total", "cnt")
    count = F.min_by("cnt", "total") if overwrite else F.sum("cnt")
    return keyed.groupBy("null_id", "stat").agg(count.cast("long").alias("cnt"))


def rounded(stat: Column, digits: int = STAT_DIGITS) -> Column:
    return F.bround(stat.cast("double"), digits)


def _axis(null: DataFrame, probes: DataFrame | None) -> DataFrame:
    """Every distinct value with its count, neighbours and the number of null rows at or above it."""
    rows = null.select("null_id", "stat", "cnt", F.lit(False).alias("asked"))
    if probes is not None:
        asked = probes.select("null_id", "stat", F.lit(0).cast("long").alias("cnt"), F.lit(True).alias("asked"))
        rows = rows.unionByName(asked)
    values = rows.groupBy("null_id", "stat").agg(F.sum("cnt").alias("cnt"), F.max("asked").alias("asked"))

    placed = values.withColumn("_range", F.floor(F.sqrt(F.greatest("stat", F.lit(0.0))) * RANGES_PER_ROOT))
    in_null = F.col("cnt") > 0
    known = F.when(in_null, F.col("stat"))

    summary = placed.groupBy("null_id", "_range").agg(
        F.sum("cnt").alias("_rows"), F.min(known).alias("_low"),
        F.max(known).alias("_high"), F.max_by("cnt", known).alias("_high_cnt"),
    )
    up = Window.partitionBy("null_id").orderBy("_range")
    down = Window.partitionBy("null_id").orderBy(F.desc("_range"))
    whole = Window.partitionBy("null_id")
    earlier = (Window.unboundedPreceding, -1)
    summary = summary.select(
        "null_id", "_range",
        F.coalesce(F.sum("_rows").over(down.rowsBetween(*earlier)), F.lit(0)).alias("_above"),
        F.last("_low", ignorenulls=True).over(down.rowsBetween(*earlier)).alias("_next"),
        F.last("_high", ignorenulls=True).over(up.rowsBetween(*earlier)).alias("_prev"),
        F.last("_high_cnt", ignorenulls=True).over(up.rowsBetween(*earlier)).alias("_prev_cnt"),
        F.sum("_rows").over(whole).alias("n"),
        F.min("_low").over(whole).alias("least"), F.max("_high").over(whole).alias("greatest"),
    )

    rising = Window.partitionBy("null_id", "_range").orderBy("stat")
    falling = Window.partitionBy("null_id", "_range").orderBy(F.desc("stat"))
    so_far = (Window.unboundedPreceding, Window.currentRow)
    local = placed.select(
        "null_id", "_range", "stat", "cnt", "asked",
        F.sum("cnt").over(falling.rowsBetween(*so_far)).alias("_at_or_above"),
        F.last(known, ignorenulls=True).over(falling.rowsBetween(*earlier)).alias("_up"),
        F.last(known, ignorenulls=True).over(rising.rowsBetween(*earlier)).alias("_dn"),
        F.last(F.when(in_null, F.col("cnt")), ignorenulls=True).over(rising.rowsBetween(*earlier)).alias("_dn_cnt"),
    )
    return local.join(summary, ["null_id", "_range"]).select(
        "null_id", "stat", "cnt", "asked", "n", "least", "greatest",
        (F.col("_at_or_above") + F.col("_above")).alias("at_or_above"),
        F.coalesce("_up", "_next").alias("next_stat"),
        F.coalesce("_dn", "_prev").alias("prev_stat"),
        F.coalesce("_dn_cnt", "_prev_cnt").alias("prev_cnt"),
    )


def p_value_table(null: DataFrame, probes: DataFrame) -> DataFrame:
    """``(null_id, stat, p)`` for the distinct probe values.

    p is the share of null rows at or above the value, linear between null values, one at or below
    the least of them and ``1 / n`` above the greatest.  A null without rows is an error.
    """
    axis = _axis(null, probes.select("null_id", rounded(F.col("stat")).alias("stat"))).filter("asked")
    x, n = F.col("stat"), F.col("n").cast("double")
    between = (F.col("next_stat") - x) / (F.col("next_stat") - F.col("prev_stat")) * F.col("prev_cnt")
    p = (
        F.when(F.col("n") == 0, F.raise_error(F.lit("null distribution without rows")))
        .when(x <= F.col("least"), F.lit(1.0))
        .when(x > F.col("greatest"), 1.0 / n)
        .when(F.col("cnt") > 0, F.col("at_or_above") / n)
        .otherwise((F.col("at_or_above") + between) / n)
    )
    return axis.select("null_id", "stat", F.round(p, P_DIGITS).alias("p"))


def with_p_value(rows: DataFrame, null: DataFrame, stat: Column, null_id: str, name: str) -> DataFrame:
    """Add the p-value of ``stat`` against the null named in column ``null_id``.

    Values are looked up once per distinct value; the join back is on the exact rounded value,
    which adaptive execution may broadcast or split when a value is very frequent.  The rows are
    read twice, so they are staged.
    """
    keyed = stage(rows.withColumn("_stat", rounded(stat)), "tested")
    probes = keyed.select(F.col(null_id).alias("null_id"), F.col("_stat").alias("stat"))
    table = p_value_table(null, probes).select(
        F.col("null_id").alias(null_id), F.col("stat").alias("_stat"), F.col("p").alias(name))
    return keyed.join(table, [null_id, "_stat"]).drop("_stat")


def thresholds(null: DataFrame, p_values: dict[str, float]) -> DataFrame:
    """``(null_id, name, p, value)``: the value whose p-value is ``p``."""
    axis = _axis(null, None)
    levels = F.explode(F.array(*[
        F.struct(F.lit(k).alias("name"), F.round(F.lit(float(v)), P_DIGITS).alias("p"))
        for k, v in p_values.items()
    ]))
    target = F.col("p") * F.col("n")
    reached = F.col("at_or_above") >= target
    picked = (
        axis.withColumn("_l", levels).select("*", "_l.*").drop("_l")
        .groupBy("null_id", "name", "p")
        .agg(
            F.max("n").alias("n"), F.max("greatest").alias("greatest"),
            F.max(F.when(reached, F.col("stat"))).alias("x0"),
            F.min(F.when(reached, F.col("at_or_above"))).alias("s0"),
            F.min(F.when(~reached, F.col("stat"))).alias("x1"),
            F.max(F.when(~reached, F.col("at_or_above"))).alias("s1"),
        )
    )
    share = (F.col("s0") - F.col("p") * F.col("n")) / (F.col("s0") - F.col("s1"))
    value = (
        F.when(F.col("p") <= 1.0 / F.col("n"), F.col("greatest"))
        .when(F.col("x1").isNull(), F.col("greatest"))
        .otherwise(F.col("x0") + share * (F.col("x1") - F.col("x0")))
    )
    return picked.select("null_id", "name", "p", value.alias("value"))
