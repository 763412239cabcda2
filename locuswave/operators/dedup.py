"""Duplicate removal by unique molecular identifier."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuswave.functions import cigar as cg
from locuswave.schema import ALIGNMENTS
from locuswave.session import stage


def with_fragment_start(alignments: DataFrame) -> DataFrame:
    """Unclipped 5' position and strand, the place two copies of a molecule share; a missing UMI raises."""
    clip = cg.five_prime_clip(F.col("cigar"), F.col("flag"))
    reverse = cg.is_reverse(F.col("flag"))
    end = F.col("pos") + cg.reference_length(F.col("cigar"))
    place = F.when(reverse, end + clip).otherwise(F.col("pos") - clip)
    alignments = alignments.withColumn("umi", F.when(
        F.coalesce(F.col("umi"), F.lit("")) == "", F.raise_error("alignment without a UMI: molecules cannot be told apart")
    ).otherwise(F.col("umi")))
    return alignments.withColumn("is_reverse", reverse).withColumn("fragment_start", place)


PLACE = ("sample_id", "chrom", "fragment_start", "is_reverse")


def molecules_of(placed: DataFrame) -> DataFrame:
    """Place, UMI, number of alignments and the best of them: highest mapping quality, then smallest read id.

    An aggregation with map-side combine, so a molecule with any number of copies is no hot spot.  It carries the
    columns of ``schema.ALIGNMENTS`` only, whatever else the alignments hold.
    """
    order = F.struct((-F.col("mapq")).alias("q"), "read_id", "pos", "flag", "cigar")
    return placed.groupBy(*PLACE, "umi").agg(F.count(F.lit(1)).alias("copies"), F.min(order).alias("_o")).select(
        *PLACE, "umi", "copies", (-F.col("_o.q")).alias("mapq"), "_o.read_id", "_o.pos", "_o.flag", "_o.cigar")


def fetch(alignments: DataFrame, chosen: DataFrame) -> DataFrame:
    """The alignments that ``chosen`` names, one each.

    If they have no columns beyond those of ``schema.ALIGNMENTS``, ``chosen`` holds them already.  Otherwise whole rows
    are shuffled and sorted once, by a key with the read id: copies of one molecule are spread over the tasks.
    """
    if set(alignments.columns) <= set(chosen.columns):
        return chosen.select(*[F.col(c).cast(alignments.schema[c].dataType).alias(c) for c in alignments.columns])
    keys = ALIGNMENTS.names
    mine = alignments.withColumn("_k", F.xxhash64(*keys))
    named = chosen.select(F.xxhash64(*keys).alias("_k"), *[F.col(c).alias(f"_{c}") for c in keys])
    same = mine["_k"] == named["_k"]
    for c in keys:
        same = same & mine[c].eqNullSafe(named[f"_{c}"])
    found = mine.join(named, same).select(mine["*"])
    # Only rows that repeat an alignment are left to tell apart.
    again = Window.partitionBy("_k", *keys).orderBy("_k")
    return found.withColumn("_n", F.row_number().over(again)).filter("_n = 1").select(*alignments.columns)


def exact_umi(alignments: DataFrame) -> DataFrame:
    """One alignment per place and UMI."""
    placed = with_fragment_start(alignments.filter(cg.is_primary(F.col("flag"))))
    return fetch(alignments, molecules_of(placed))


def directional_umi(alignments: DataFrame) -> DataFrame:
    """One alignment per place and UMI cluster.

    A UMI absorbs another at Hamming distance one when it is at least twice as frequent less one, and what that one
    absorbs.  A UMI belongs to the most frequent one (the smallest of equals) that reaches it this way.
    """
    placed = with_fragment_start(alignments.filter(cg.is_primary(F.col("flag"))))
    molecules = stage(molecules_of(placed), "molecules")
    owned = umi_owners(molecules).filter("owner <> umi")
    # The owner's own best read stays; an absorbed UMI is an error, however well its read maps.
    kept = molecules.alias("m").join(
        owned.alias("o"), _same("m", "o", [*PLACE, "umi"]), "left_anti")
    return fetch(alignments, kept)


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def umi_steps(molecules: DataFrame) -> DataFrame:
    """Directional steps (place, src, src_copies, dst, dst_copies) between UMIs one substitution apart.

    UMIs that agree in all letters but one share the key with that letter blanked out, and a key has at most as
    many members as there are letters: the neighbours meet by equality, whatever the number of UMIs at a place.
    """
    crowded = molecules.groupBy(*PLACE).agg(F.count(F.lit(1)).alias("_umis")).filter("_umis > 1")
    some = molecules.alias("m").join(crowded.alias("c"), _same("m", "c", PLACE), "left_semi")
    at = F.col("_at")
    blank = F.concat(F.expr("substring(umi, 1, _at - 1)"), F.lit("."), F.expr("substring(umi, _at + 1)"))
    keyed = some.withColumn("_at", F.explode(F.sequence(F.lit(1), F.length("umi")))).select(
        *PLACE, at, blank.alias("_key"), F.struct("umi", "copies").alias("_u"))
    met = keyed.groupBy(*PLACE, "_key").agg(F.collect_list("_u").alias("_us")).filter(F.size("_us") > 1)
    pairs = met.select(*PLACE, "_us", F.explode("_us").alias("_a")).select(
        *PLACE, "_a", F.explode("_us").alias("_b")).filter("_a.umi <> _b.umi and _a.copies >= 2 * _b.copies - 1")
    return pairs.select(*PLACE, F.col("_a.umi").alias("src"), F.col("_a.copies").alias("src_copies"),
                        F.col("_b.umi").alias("dst"), F.col("_b.copies").alias("dst_copies"))


def umi_owners(molecules: DataFrame) -> DataFrame:
    """(place, umi, owner) of every UMI that some step leads to.

    The smallest label, a UMI by falling count, is handed along the steps until no label changes; what a UMI's label
    names already reaches it, so each round also looks up the label's own label and paths shrink by halves.
    """
    label = lambda copies, umi: F.struct((-F.col(copies)).alias("rank"), F.col(umi).alias("umi"))
    steps = stage(umi_steps(molecules), "umi-steps")
    first = steps.select(*PLACE, F.col("dst").alias("umi"), F.explode(F.array(
        label("src_copies", "src"), label("dst_copies", "dst"))).alias("label"))
    now = stage(_least(first), "umi-labels")
    hops, mark = steps.select(*PLACE, F.col("src").alias("umi"), "dst"), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*PLACE, "umi", "label").cast("decimal(38,0)"))).first()
        if state == mark or not state[0]:
            return now.select(*PLACE, "umi", F.col("label.umi").alias("owner"))
        mark = state
        handed = hops.alias("h").join(now.alias("n"), _same("h", "n", [*PLACE, "umi"])).select(
            *[F.col(f"h.{c}") for c in PLACE], F.col("h.dst").alias("umi"), F.col("n.label").alias("label"))
        named = now.select(*PLACE, F.col("label.umi").alias("umi"), F.col("umi").alias("of"))
        jumped = named.alias("h").join(now.alias("n"), _same("h", "n", [*PLACE, "umi"])).select(
            *[F.col(f"h.{c}") for c in PLACE], F.col("h.of").alias("umi"), F.col("n.label").alias("label"))
        now = stage(_least(now.unionByName(handed).unionByName(jumped)), "umi-labels")


def _least(labels: DataFrame) -> DataFrame:
    return labels.groupBy(*PLACE, "umi").agg(F.min("label").alias("label"))


def dedup_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """Alignments before and after per sample, and the share removed in percent."""
    total = before.filter(cg.is_primary(F.col("flag"))).groupBy("sample_id").agg(F.count(F.lit(1)).alias("total_umis"))
    kept = after.groupBy("sample_id").agg(F.count(F.lit(1)).alias("total_dedup_umis"))
    pct = F.lit(100.0) * (F.col("total_umis") - F.col("total_dedup_umis")) / F.col("total_umis")
    return total.join(kept, "sample_id").withColumn("pct_duplication", pct)
