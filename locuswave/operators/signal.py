"""Sliding-window sums and differences over sparse counts, as run-length intervals.

A count ``c`` at position ``p`` contributes ``c`` to every position of ``[p - W, p + W]``; so it is
a step up at ``p - W`` and a step down at ``p + W + 1``, and the window sum is the running total of
the steps.  The running total is computed per tile of the chromosome.  Every step pair is clipped
to the tiles it reaches, so tiles need no carry from each other; each tile also sees one base pair
on either side, which tells whether its first and last run continue there.

The pieces of the tiles are written once as a stage table; joining the few pieces cut at tile edges
is then a cheap view on it, which every consumer may read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locuswave.schema import add_all, value_names
from locuswave.session import stage, tasks_for

KEYS = ["grp", "chrom"]
# Positions per task, which takes about a kilobyte of memory for each.
TASK_ROWS = 400_000


def window_sums(counts: DataFrame, n: int, half_width: int, tile: int = 8_192,
                contigs: DataFrame | None = None) -> DataFrame:
    """Runs ``(grp, chrom, start, stop, v1..vn)`` of equal, non-zero window sums.

    ``counts`` has one row ``(grp, chrom, pos, v1..vn)`` per position.
    """
    return _runs(_spans(counts, half_width, contigs), n, tile, clip=False)


def window_diffs(test: DataFrame, control: DataFrame, n: int, half_width: int,
                 tile: int = 8_192, contigs: DataFrame | None = None) -> DataFrame:
    """Runs of ``max(test sum - control sum, 0)``, clipped per replicate after both sums.

    Both inputs carry the id of the *test* group in ``grp`` (see ``fan_out_control``).
    """
    names = value_names(n)
    signed = test.select(*KEYS, "pos", *names).unionByName(
        control.select(*KEYS, "pos", *[(-F.col(c)).alias(c) for c in names])
    )
    return _runs(_spans(signed, half_width, contigs), n, tile, clip=True)


def rotate(counts: DataFrame, n: int) -> DataFrame:
    """Replicate vectors rotated left by one: v2, v3, .., v1."""
    if n < 2:
        raise ValueError("a control needs at least two replicates to be compared with itself")
    names = value_names(n)
    turned = names[1:] + names[:1]
    others = [c for c in counts.columns if c not in names]
    return counts.select(*others, *[F.col(s).alias(d) for s, d in zip(turned, names)])


def self_diffs(control: DataFrame, n: int, half_width: int, tile: int = 8_192,
               contigs: DataFrame | None = None) -> DataFrame:
    """Null signal: every control replicate corrected by the next one."""
    if n < 2:
        raise ValueError("a control needs at least two replicates to be compared with itself")
    names = value_names(n)
    # Vector minus its rotation, within the row: no join and no union.
    signed = control.select(*KEYS, "pos", *[
        (F.col(c) - F.col(t)).alias(c) for c, t in zip(names, names[1:] + names[:1])
    ])
    return _runs(_spans(signed, half_width, contigs), n, tile, clip=True)


def fan_out_control(control: DataFrame, groups: DataFrame) -> DataFrame:
    """Copy each control group's rows to the test groups that refer to it.

    ``groups`` maps ``grp`` to ``control_grp``, one row per sample-sheet group.
    """
    pairs = groups.select("grp", "control_grp")
    return (
        control.withColumnRenamed("grp", "control_grp")
        .join(F.broadcast(pairs), "control_grp")
        .drop("control_grp")
    )


def _spans(counts: DataFrame, half_width: int, contigs: DataFrame | None) -> DataFrame:
    low = F.greatest(F.col("pos") - F.lit(half_width), F.lit(0).cast("long"))
    high = F.col("pos") + F.lit(half_width + 1)
    if contigs is not None:
        # One row per contig of the genome index.
        counts = counts.join(F.broadcast(contigs), "chrom", "left")
        counts = counts.withColumn("length", F.when(
            F.col("length").isNull(),
            F.raise_error(F.concat(F.lit("contig not in the genome index: "), F.col("chrom"))),
        ).otherwise(F.col("length")))
        high = F.least(high, F.col("length"))
    spans = counts.withColumn("_lo", low).withColumn("_hi", high).drop("pos", "length")
    return spans.filter("_lo < _hi")


def _runs(spans: DataFrame, n: int, tile: int, clip: bool) -> DataFrame:
    names = value_names(n)
    part = ["_tile", *KEYS]
    kind = {c: spans.schema[c].dataType for c in names}  # sums of decimals must not widen
    first = F.greatest(F.expr(f"(_lo - 1) div {tile}"), F.lit(0).cast("long"))
    last = F.expr(f"_hi div {tile}")
    # Shuffled as one row per position and tile; the two steps are made on the other side.
    spans = stage(spans, "spans")
    placed = spans.withColumn("_tile", F.explode(F.sequence(first, last))).repartition(tasks_for(spans, TASK_ROWS), *part)

    left, right = F.col("_tile") * tile - 1, (F.col("_tile") + 1) * tile + 1
    step = F.explode(F.array(
        F.struct(F.greatest("_lo", left).alias("x"), F.lit(1).alias("sign")),
        F.struct(F.least("_hi", right).alias("x"), F.lit(-1).alias("sign")),
    ))
    steps = (
        placed.withColumn("_step", step)
        .select(*part, F.col("_step.x").alias("x"),
                *[F.when(F.col("_step.sign") > 0, F.col(c)).otherwise(-F.col(c)).alias(c) for c in names])
        .filter(F.col("x") < right)
        .groupBy(*part, "x").agg(*[F.sum(c).cast(kind[c]).alias(c) for c in names])
        .filter(_any([F.col(c) != 0 for c in names]))
    )

    w = Window.partitionBy(*part).orderBy("x")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = steps.select(*part, "x", *[F.sum(c).over(upto).cast(kind[c]).alias(c) for c in names])
    if clip:
        # Clipping can make neighbouring levels equal: keep a level only where it changes.
        levels = levels.select(*part, "x", *[
            F.greatest(F.col(c), F.lit(0).cast(kind[c])).alias(c) for c in names
        ])
        before = [F.lag(c, 1).over(w).alias(f"_p{c}") for c in names]
        levels = levels.select("*", *before).filter(
            _any([F.col(c) != F.coalesce(F.col(f"_p{c}"), F.lit(0)) for c in names])
        ).drop(*[f"_p{c}" for c in names])
    runs = levels.withColumn("_end", F.coalesce(F.lead("x").over(w), right))
    runs = runs.filter(add_all([F.col(c) for c in names]) > 0)

    lo, hi = F.col("_tile") * tile, (F.col("_tile") + 1) * tile
    pieces = runs.filter((F.col("_end") > lo) & (F.col("x") < hi)).select(
        *KEYS,
        F.greatest(F.col("x"), lo).alias("start"), F.least(F.col("_end"), hi).alias("stop"),
        *names, (F.col("x") < lo).alias("_from_left"), (F.col("_end") > hi).alias("_to_right"),
    )
    return _stitch(stage(pieces, "runs"), names)


def _stitch(pieces: DataFrame, names: list[str]) -> DataFrame:
    """Join runs cut at tile edges; at most two pieces per tile go through the second window."""
    cut = F.col("_from_left") | F.col("_to_right")
    out = [*KEYS, "start", "stop", *names]
    whole = pieces.filter(~cut).select(*out)
    w = Window.partitionBy(*KEYS).orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = (
        pieces.filter(cut)
        .withColumn("_chain", F.sum((~F.col("_from_left")).cast("int")).over(w))
        .groupBy(*KEYS, "_chain")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"), *[F.max(c).alias(c) for c in names])
    )
    return whole.unionByName(joined.select(*out))


def _any(conditions):
    combined = conditions[0]
    for condition in conditions[1:]:
        combined = combined | condition
    return combined


def value_histogram(runs: DataFrame, n: int) -> DataFrame:
    """Base pairs per window-sum total: ``(grp, total, mean, cnt)``."""
    total = F.round(add_all([F.col(c) for c in value_names(n)]), 10)
    hist = runs.groupBy("grp", total.alias("total")).agg(
        F.sum(F.col("stop") - F.col("start")).alias("cnt"))
    return hist.select("grp", "total", (F.col("total") / F.lit(n)).cast("double").alias("mean"), "cnt")
