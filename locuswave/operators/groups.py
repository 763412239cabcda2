"""Sample-sheet grouping and its consistency rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuswave.operators.ranking import ordinal

ERROR, WARNING = "error", "warning"
OPTIONAL_TEXT = ("control_group", "on_target_motif", "on_target_location")


def with_ids(sheet: DataFrame) -> DataFrame:
    """Add ``sample_id`` and ``grp`` (replicate group); blank text becomes NULL."""
    blank = {c: F.when(F.trim(F.col(c)) != "", F.col(c)) for c in (*OPTIONAL_TEXT, "fastq_2") if c in sheet.columns}
    grp = F.format_string("%s_%dnM", "sample_group", "concentration")
    return sheet.withColumns(blank).withColumn("grp", grp).withColumn(
        "sample_id", F.format_string("%s_%dnM_R%d", "sample_group", "concentration", "replicate"))


def controls_first(samples: DataFrame) -> DataFrame:
    """Sample order of a run: controls, then sample groups, each by concentration and replicate."""
    return samples.orderBy((F.col("concentration") == 0).desc(), "sample_group", "concentration", "replicate")


def lanes(sheet: DataFrame, sample: str = "sample_id", file: str = "fastq_1") -> DataFrame:
    """Number the lanes of every sample in file order; their reads are simply added up."""
    return ordinal(sheet, [sample], [F.asc(file)], "lane")


def replicate_groups(samples: DataFrame, limits: DataFrame | None = None) -> DataFrame:
    """One row per (sample group, concentration) with its replicates in order.

    With ``limits`` (see ``control_limits``) control replicates are cut to the number their tests
    use, at least two; controls no test refers to are left out.
    """
    rows = samples.select("grp", "sample_group", "concentration", "control_group", "replicate", "sample_id")
    if limits is not None:
        order = Window.partitionBy("grp").orderBy("replicate")
        rows = (
            rows.join(F.broadcast(limits), "sample_group", "left")
            .withColumn("_n", F.row_number().over(order))
            .filter((F.col("concentration") > 0) | (F.col("_n") <= F.greatest(F.col("control_limit"), F.lit(2))))
        )
    members = F.sort_array(F.collect_list(F.struct("replicate", "sample_id")))
    return rows.groupBy("grp", "sample_group", "concentration", "control_group").agg(members.alias("members")).select(
        "grp", "sample_group", "concentration", "control_group",
        F.col("members.replicate").alias("replicates"), F.col("members.sample_id").alias("sample_ids"),
        F.size("members").alias("n_reps"))


def control_limits(samples: DataFrame) -> DataFrame:
    """Replicates per test group for every referenced control ``(sample_group, control_limit)``."""
    sizes = samples.filter("concentration > 0").groupBy("grp", "control_group").agg(F.count(F.lit(1)).alias("k"))
    limits = sizes.groupBy(F.col("control_group").alias("sample_group")).agg(
        F.min("k").alias("least"), F.max("k").alias("control_limit"))
    checked = F.when(F.col("least") == F.col("control_limit"), F.col("control_limit")).otherwise(F.raise_error(
        F.concat(F.lit("tests of one control have different replicate counts: "), F.col("sample_group"))))
    return limits.select("sample_group", checked.alias("control_limit"))


def group_sizes(samples: DataFrame) -> DataFrame:
    """Concentrations and samples per sample group."""
    return samples.groupBy("sample_group").agg(
        F.countDistinct("concentration").alias("n_concs"), F.count(F.lit(1)).alias("n_samples"))


def test_control_pairs(groups: DataFrame) -> DataFrame:
    """Test groups with the control group they refer to: many tests may share a control."""
    controls = groups.filter("concentration = 0").select(
        F.col("sample_group").alias("control_group"), F.col("grp").alias("control_grp"),
        F.col("n_reps").alias("control_reps"))
    tests = groups.filter("concentration > 0")
    return tests.join(F.broadcast(controls), "control_group").select(
        "sample_group", F.col("concentration").alias("conc"), "grp", "control_grp", "n_reps", "control_reps")


# -- rules -------------------------------------------------------------------------------------


def violations(samples: DataFrame, use_umis: bool = True) -> DataFrame:
    """All broken rules as rows ``(rule, severity, subject)``; ``samples`` comes from ``with_ids``.

    Two aggregations judge everything: one with grouping sets over samples, replicate groups and sample groups for the
    rules on fields, one per replicate group for the rules on numbers of replicates, compared inside sample groups and
    between tests and their control by windows over these few rows.
    """
    control, test = F.col("concentration") == 0, F.col("concentration") > 0
    paired = F.col("fastq_2").isNotNull()
    filled = F.coalesce(*[F.col(c) for c in OPTIONAL_TEXT]).isNotNull()
    missing = F.col("control_group").isNull() | F.col("on_target_motif").isNull() | F.col("on_target_location").isNull()

    sets = samples.groupingSets([["sample_id"], ["grp"], ["sample_group"]], "sample_id", "grp", "sample_group").agg(
        F.grouping_id().alias("_set"), F.bool_or(F.col("concentration") < 0).alias("negative"),
        F.bool_or(control & filled).alias("filled"), F.bool_or(test & missing).alias("missing"),
        F.bool_and(paired).alias("paired"), F.bool_or(paired).alias("some_paired"),
        *[_differs(c).alias(f"{c}_differs") for c in OPTIONAL_TEXT])
    # Bits of the grouping: 1 for a column that is not grouped by; the first column is the highest bit.
    sample, group, sample_group = F.col("_set") == 3, F.col("_set") == 5, F.col("_set") == 6
    differ = F.col("control_group_differs") | F.col("on_target_motif_differs") | F.col("on_target_location_differs")
    fields = _broken(sets, {
        ("conc_negative", ERROR, "sample_id"): sample & F.col("negative"),
        ("control_fields_not_blank", ERROR, "sample_id"): sample & F.col("filled"),
        ("test_fields_missing", ERROR, "sample_id"): sample & F.col("missing"),
        ("umis_need_fastq_2", ERROR, "sample_id"): sample & ~F.col("paired") & F.lit(use_umis),
        ("mixed_endedness", ERROR, "sample_id"): sample & F.col("some_paired") & ~F.col("paired"),
        ("replicate_group_fields_differ", ERROR, "grp"): group & differ,
        ("sample_group_fields_differ", ERROR, "sample_group"): sample_group & differ,
    })

    sizes = samples.groupBy("grp", "sample_group", "concentration", "control_group").agg(
        F.countDistinct("sample_id").alias("n"), F.bool_and(paired).alias("paired"))
    sizes = sizes.withColumn("_control", F.when(control, F.col("sample_group")).when(test, F.col("control_group")))
    within, linked = Window.partitionBy("sample_group"), Window.partitionBy("_control")

    def of(kind: Column, column: str, over) -> tuple[Column, Column]:
        value = F.when(kind, F.col(column))
        return F.min(value).over(over), F.max(value).over(over)

    least_control, most_control = of(control, "n", linked)
    least_test, most_test = of(test, "n", linked)
    control_paired, any_control_paired = of(control, "paired", linked)
    counted = sizes.select(
        "*", (F.min("n").over(within) != F.max("n").over(within)).alias("uneven"),
        least_control.alias("least_control"), most_control.alias("most_control"), least_test.alias("least_test"),
        most_test.alias("most_test"), control_paired.alias("all_control_paired"), any_control_paired.alias("any_control_paired"))
    numbers = _broken(counted, {
        ("control_needs_two_replicates", ERROR, "grp"): control & (F.col("n") < 2),
        ("uneven_replicates", WARNING, "sample_group"): F.col("uneven"),
        ("control_with_uneven_tests", ERROR, "_control"): test & (F.col("least_test") != F.col("most_test")),
        ("unmatched_test_group", ERROR, "grp"): test & (F.col("_control").isNull() | F.col("most_control").isNull()),
        ("unused_control_group", WARNING, "_control"): control & F.col("most_test").isNull(),
        ("more_tests_than_controls", ERROR, "grp"): test & F.col("_control").isNotNull() & (F.col("n") > F.col("least_control")),
        ("fewer_tests_than_controls", WARNING, "grp"): test & F.col("_control").isNotNull() & (F.col("n") > 1) & (
            F.col("n") < F.col("most_control")),
        ("endedness_differs_from_control", ERROR, "grp"): test & F.col("_control").isNotNull() & (
            (F.col("paired") != F.col("all_control_paired")) | (F.col("paired") != F.col("any_control_paired"))),
    })
    return fields.unionByName(numbers).distinct()


def _differs(column: str) -> Column:
    """Whether rows disagree about a column; NULL is a value of its own."""
    return F.coalesce(F.min(column) != F.max(column), F.lit(False)) | (
        (F.count(column) > 0) & (F.count(column) < F.count(F.lit(1))))


def _broken(rows: DataFrame, rules: dict[tuple[str, str, str], Column]) -> DataFrame:
    """One row per rule and subject whose condition holds."""
    found = F.filter(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.lit(severity).alias("severity"), F.col(subject).cast("string").alias("subject"),
                 F.coalesce(condition, F.lit(False)).alias("_broken"))
        for (name, severity, subject), condition in rules.items()]), lambda r: r["_broken"])
    return rows.select(F.explode(found).alias("r")).select("r.rule", "r.severity", "r.subject")


def require_valid(samples: DataFrame, use_umis: bool = True) -> list[str]:
    """Raise on broken rules; returns the warnings.  The sample sheet is small by nature."""
    rows = violations(samples, use_umis).orderBy("rule", "subject").collect()
    errors = [f"{r.rule}: {r.subject}" for r in rows if r.severity == ERROR]
    if errors:
        raise ValueError("invalid sample sheet: " + "; ".join(errors))
    return [f"{r.rule}: {r.subject}" for r in rows]


def keyed_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join that fails when a key is repeated on a side or missing on the other."""
    def once(df: DataFrame, flag: str) -> DataFrame:
        twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*df.columns)).alias("_row"))
        row = F.when(F.col("_n") == 1, F.col("_row")).otherwise(F.raise_error(F.lit("duplicate key in join")))
        return twice.select(*keys, row.alias(flag))

    joined = once(left, "_l").join(once(right, "_r"), keys, "full")
    both = F.when(F.col("_l").isNotNull() & F.col("_r").isNotNull(), F.col("_l")).otherwise(
        F.raise_error(F.lit("key without partner in join")))
    rest = [c for c in right.columns if c not in keys]
    return joined.withColumn("_l", both).select("_l.*", *[F.col(f"_r.{c}").alias(c) for c in rest])
