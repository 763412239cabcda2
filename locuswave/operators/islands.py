"""Chaining of sorted intervals that stays parallel on a single huge chromosome.

A chromosome is cut into fixed-width tiles, each small enough for one task.  Work is done per
tile; only what touches a tile edge (at most two rows per tile) is chained across tiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def island_best(
    df: DataFrame,
    keys: Sequence[str],
    gap: int,
    priority: Sequence[Column],
    payload: Sequence[str],
    start: str = "start",
    stop: str = "stop",
    tile: int = 8_192,
) -> DataFrame:
    """One row per island: the row with the greatest ``priority`` tuple.

    Rows sorted by ``start`` belong to the same island while ``start <= previous stop + gap``.
    ``priority`` must be unique inside an island, so that the winner is deterministic.
    Returns ``keys``, ``island_start``, ``island_stop``, ``members`` and the payload of the winner.
    A tile should be several gaps wide: in narrower ones every island reaches an edge, and all are chained together.
    """
    keys = list(keys)
    order = [p.alias(f"_k{i}") for i, p in enumerate(priority)]
    rows = df.select(
        *keys,
        F.floor(F.col(start) / tile).cast("long").alias("_tile"),
        F.col(start).alias("_s"),
        F.col(stop).alias("_e"),
        F.struct(*order, *payload).alias("_best"),
    ).repartition(*keys, "_tile")

    in_tile = Window.partitionBy(*keys, "_tile").orderBy("_s")
    local = _number(rows, in_tile, gap).groupBy(*keys, "_tile", "_isl").agg(
        F.min("_s").alias("_s"), F.max("_e").alias("_e"),
        F.max("_best").alias("_best"), F.count(F.lit(1)).alias("_n"),
    )

    # Only the first and last island of a tile can continue in a neighbouring tile.
    per_tile = Window.partitionBy(*keys, "_tile")
    edge = (F.col("_isl") == 1) | (F.col("_isl") == F.max("_isl").over(per_tile))
    parts = local.withColumn("_part", F.when(edge, F.lit(-1).cast("long")).otherwise(F.col("_tile")))
    in_part = Window.partitionBy(*keys, "_part").orderBy("_s")
    return (
        _number(parts.drop("_isl"), in_part, gap)
        .groupBy(*keys, "_part", "_isl")
        .agg(
            F.min("_s").alias("island_start"), F.max("_e").alias("island_stop"),
            F.sum("_n").alias("members"), F.max("_best").alias("_best"),
        )
        .select(*keys, "island_start", "island_stop", "members", *[f"_best.{c}" for c in payload])
    )


def _number(df: DataFrame, window, gap: int) -> DataFrame:
    """Running island number: a row opens an island when it starts beyond the previous stop + gap."""
    opens = F.coalesce(F.col("_s") > F.lag("_e").over(window) + F.lit(gap), F.lit(True))
    flagged = df.withColumn("_open", opens.cast("int"))
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return flagged.withColumn("_isl", F.sum("_open").over(upto)).drop("_open")
