"""Consensus sites of a sample group across concentrations."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuswave.operators.calling import Evidence, judge
from locuswave.operators.intervals import lookup
from locuswave.operators.islands import island_best
from locuswave.operators.ranking import ordinal, rank_from_zero_if
from locuswave.params import Params
from locuswave.schema import mean_of, total_of, value_names
from locuswave.session import fits_broadcast, stage

SITE = ["sample_group", "chrom", "pos"]
MOTIF_FIELDS = ["is_on_target", "motif_location", "closest_motif", "motif_score", "num_subs", "num_gaps"]


def value_columns(n: int, m: int) -> list[str]:
    return [*value_names(n), *value_names(n, "t"), *value_names(m, "c"), *value_names(m, "w")]


def complete_grid(reported: DataFrame, groups: DataFrame, diffs: DataFrame, evidence: Evidence,
                  params: Params) -> DataFrame:
    """Every reported location at every concentration of its sample group, in long form.

    Cells without a reported site are judged from the signal tables, without early termination;
    their motif fields stay NULL.  ``groups`` has one row per sample-sheet group
    ``(sample_group, conc, grp, control_grp)``.
    """
    n, m = evidence.n, evidence.m
    cells = reported.select(*SITE).distinct().join(
        F.broadcast(groups.select("sample_group", "conc", "grp", "control_grp")), "sample_group")
    missing = stage(cells.join(reported.select("grp", "chrom", "pos"), ["grp", "chrom", "pos"], "left_anti"),
                    "missing-cells")
    signal = lookup(missing, diffs, n, "v", bucket=params.lookup_bucket, small=fits_broadcast(missing))
    judged = judge(signal, evidence, params, early=False)
    columns = [*SITE, "conc", "grp", "control_grp", *value_columns(n, m), "test_pval", "background_pval",
               "digested", "high_background", "site_called"]
    empty = [F.lit(None).cast(reported.schema[c].dataType).alias(c) for c in MOTIF_FIELDS]
    return reported.select(*columns, *MOTIF_FIELDS).unionByName(judged.select(*columns, *empty))


def site_tuples(grid: DataFrame, n: int) -> DataFrame:
    """One row per location: its sites by rising concentration and the tuple it is compared by.

    The tuple is (on target, mean signal per concentration, total signal), where a concentration
    counts only if the site is called there and at all higher ones.
    """
    fields = [c for c in grid.columns if c not in SITE]
    long = grid.withColumn("mean_signal", mean_of(n)).withColumn("total_signal", total_of(n))
    # As many entries as the sample group has concentrations.
    sites = F.array_sort(F.collect_list(F.struct("conc", *[f for f in fields if f != "conc"],
                                                 "mean_signal", "total_signal")))
    rows = long.groupBy(*SITE).agg(
        sites.alias("sites"), F.sum("total_signal").alias("total_signal"),
        *[F.max(c).alias(c) for c in MOTIF_FIELDS],
    )
    return rows.withColumn("is_on_target", F.coalesce("is_on_target", F.lit(False))).withColumn(
        "called_signals", called_signals(F.col("sites")))


def called_signals(sites: Column) -> Column:
    def signal(site: Column, index: Column) -> Column:
        rest = F.slice(sites, index + 1, F.size(sites))
        unbroken = F.forall(rest, lambda s: s["site_called"])
        return F.when(unbroken, site["mean_signal"].cast("double")).otherwise(F.lit(0.0))

    return F.transform(sites, signal)


def consensus(tuples: DataFrame, params: Params) -> DataFrame:
    """The greatest site of every chain of locations closer than the collapse window.

    On equal tuples the lower position stays.
    """
    return island_best(
        tuples, keys=["sample_group", "chrom"], gap=params.agg_peak_window,
        priority=[F.col("is_on_target"), F.col("called_signals"), F.col("total_signal"), -F.col("pos")],
        payload=[c for c in tuples.columns if c not in ("sample_group", "chrom")],
        start="pos", stop="pos", tile=params.tile,
    ).drop("island_start", "island_stop", "members")


def rank_consensus(sites: DataFrame) -> DataFrame:
    ordered = ordinal(
        sites, ["sample_group"],
        [F.desc("is_on_target"), F.desc("called_signals"), F.desc("total_signal"), F.asc("chrom"), F.asc("pos")])
    return rank_from_zero_if(ordered, ["sample_group"], "is_on_target", "ordinal", "rank")


def highest_signals(ranked: DataFrame, n: int) -> DataFrame:
    """Highest signal per sample group, concentration and replicate over all consensus sites."""
    long = ranked.select("sample_group", F.explode("sites").alias("s"))
    return long.groupBy("sample_group", F.col("s.conc").alias("conc")).agg(
        *[F.max(F.col(f"s.{c}")).alias(f"top{k}") for k, c in enumerate(value_names(n), 1)])


def pivot_concentrations(ranked: DataFrame, concs: Sequence[int], n: int, m: int, params: Params) -> DataFrame:
    """Published wide form: shared columns, then ``{conc}nM_{field}`` per concentration.

    Sites already lie side by side in one row, so no second shuffle is needed; the highest signals
    (one row per sample group) are attached for the share of the maximum.
    """
    names = value_names(n)
    tops = highest_signals(ranked, n).groupBy("sample_group").agg(*[
        F.max(F.when(F.col("conc") == conc, F.col(f"top{k}"))).alias(f"_top{conc}_{k}")
        for conc in concs for k in range(1, n + 1)
    ])
    rows = ranked.join(F.broadcast(tops), "sample_group")
    rows = rows.withColumns({f"_s{conc}": _site_at(conc) for conc in concs})
    wide = "c" if params.compat_wide_totals else "w"
    first = F.get(F.col("sites"), 0)

    def values(prefix: str, width: int) -> Column:
        return F.array(*[first[c].cast("double") for c in value_names(width, prefix)])

    def added(prefix: str, width: int) -> Column:
        parts = [first[c] for c in value_names(width, prefix)]
        return sum(parts[1:], parts[0])

    shared = [
        "sample_group", "rank", "chrom", F.col("pos").alias("position"), (F.col("pos") + 1).alias("position_1b"),
        "closest_motif", "is_on_target", "motif_location", "motif_score", "num_subs", "num_gaps", "total_signal",
        first["background_pval"].alias("background_pval"), first["high_background"].alias("high_background"),
        added("c", m).alias("total_control_reads"), added(wide, m).alias("total_wide_control_reads"),
        (added(wide, m).cast("double") / F.lit(m)).alias("mean_wide_control_reads"),
        values("c", m).alias("control_read_vals"), values("w", m).alias("wide_control_read_vals"),
    ]
    by_conc = []
    for conc in concs:
        site = F.col(f"_s{conc}")
        pct = [
            F.when(F.col(f"_top{conc}_{k}") > 0, F.lit(100.0) * site[c] / F.col(f"_top{conc}_{k}")).cast("double")
            for k, c in enumerate(names, 1)
        ]
        tests = [site[c] for c in value_names(n, "t")]
        fields = {
            "site_called": site["site_called"], "test_pval": site["test_pval"],
            "mean_pct_max_peak": sum(pct[1:], pct[0]) / F.lit(n), "pct_max_peak_vals": F.array(*pct),
            "mean_signal": site["mean_signal"], "signal_vals": F.array(*[site[c].cast("double") for c in names]),
            "total_test_reads": sum(tests[1:], tests[0]),
            "test_read_vals": F.array(*[t.cast("double") for t in tests]),
            "total_signal": site["total_signal"], "digested": site["digested"],
        }
        by_conc += [column.alias(f"{conc}nM_{name}") for name, column in fields.items()]
    return rows.select(*shared, *by_conc)


def _site_at(conc: int) -> Column:
    return F.get(F.filter("sites", lambda s: s["conc"] == conc), 0)


# Fixed value: names of per-concentration columns.
BY_CONC = r"^(\d+)nM_(\S+)$"


def unpivot_concentrations(wide: DataFrame) -> DataFrame:
    """Long form of the published wide table: shared columns, ``conc`` and one column per field."""
    found = [(c, re.match(BY_CONC, c)) for c in wide.columns]
    fields: dict[int, dict[str, str]] = {}
    for column, match in found:
        if match:
            fields.setdefault(int(match[1]), {})[match[2]] = column
    shared = [c for c, match in found if not match]
    cells = F.explode(F.array(*[
        F.struct(F.lit(conc).alias("conc"), *[F.col(column).alias(_long_name(name, shared)) for name, column in columns.items()])
        for conc, columns in sorted(fields.items())
    ]))
    return wide.select(*shared, cells.alias("_cell")).select(*shared, "_cell.*")


def _long_name(name: str, shared: Sequence[str]) -> str:
    return f"site_{name}" if name in shared else name


def called_breakdown(wide: DataFrame, concs: Sequence[int]) -> DataFrame:
    """Per concentration: called sites, whether the on-target is called, highest called signal."""
    long = F.explode(F.array(*[
        F.struct(F.lit(c).alias("conc"), F.col(f"{c}nM_site_called").alias("called"),
                 F.col(f"{c}nM_mean_signal").cast("double").alias("signal"))
        for c in concs
    ]))
    cells = wide.select("sample_group", "is_on_target", long.alias("c")).select("sample_group", "is_on_target", "c.*")
    return cells.groupBy("sample_group", "conc").agg(
        F.count_if("called").alias("sites_called"),
        F.coalesce(F.bool_or(F.col("is_on_target") & F.col("called")), F.lit(False)).alias("on_target_called"),
        F.max(F.when(F.col("called"), F.col("signal"))).alias("max_called_signal"),
    )


def integrity_violations(grid: DataFrame, m: int) -> DataFrame:
    """Locations whose shared fields differ between concentrations; empty when all is well."""
    control = F.struct(*value_names(m, "c"), *value_names(m, "w"), "background_pval", "high_background")
    checks = grid.groupBy(*SITE).agg(
        (F.min(control) != F.max(control)).alias("control_differs"),
        *[(F.min(c) != F.max(c)).alias(f"{c}_differs") for c in MOTIF_FIELDS if c != "is_on_target"],
        F.count_if(F.col("conc").isNull()).alias("without_conc"),
    )
    broken = F.col("control_differs") | (F.col("without_conc") > 0)
    for c in MOTIF_FIELDS[1:]:
        broken = broken | F.coalesce(F.col(f"{c}_differs"), F.lit(False))
    return checks.filter(broken)
