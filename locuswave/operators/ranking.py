"""Ranks over any number of rows, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuswave.session import stage


def ordinal(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "ordinal") -> DataFrame:
    """1, 2, 3, .. within ``group`` in the given total order.

    Rows are range-partitioned on group and order, sorted inside partitions and staged; a row's
    ordinal is its place in its partition plus the group's rows in earlier partitions.
    """
    group = list(group)
    placed = (
        df.repartitionByRange(*[F.col(g) for g in group], *order)
        .sortWithinPartitions(*[F.col(g) for g in group], *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_seq", F.monotonically_increasing_id())
    )
    placed = stage(placed, "ranked")
    # One row per group and range partition: groups may be many, so the planner chooses the join by size.
    heads = placed.groupBy(*group, "_part").agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = heads.select(
        *group, "_part", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.col("_seq") - F.col("_first") + 1
    return (
        placed.join(offsets, [*group, "_part"])
        .withColumn(name, rank.cast("long"))
        .select(*df.columns, name)
    )


def rank_from_zero_if(ranked: DataFrame, group: Sequence[str], flag: str, ordinal_name: str, name: str) -> DataFrame:
    """Ranks start at 0 in groups where some row has ``flag``, else at 1."""
    found = ranked.groupBy(*group).agg(F.max(F.coalesce(F.col(flag), F.lit(False))).alias("_found"))
    return (
        ranked.join(found, list(group))
        .withColumn(name, F.col(ordinal_name) - F.col("_found").cast("long"))
        .drop("_found", ordinal_name)
    )
