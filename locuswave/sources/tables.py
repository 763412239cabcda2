"""Sample sheets, signal and histogram tables, tool reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locuswave.schema import SAMPLE_SHEET, value_names
from locuswave.session import bounded_side, stage
from locuswave.sources.text_lines import split_lines

# Formats of the sample-sheet columns.
FORMATS = {
    "sample_group": r"^\S+$", "control_group": r"^\S+$",
    "on_target_motif": r"^[AGCTRYBDKMHVSWNagctrybdkmhvswn]+$",
    "on_target_location": r"^[A-Za-z0-9-_.]+:[\d,]+-[\d,]+(,(\+|-))?$",
    "fastq_1": r"^\S+\.f(ast)?q\.gz$", "fastq_2": r"^\S+\.f(ast)?q\.gz$",
}
REQUIRED = ("sample_group", "concentration", "replicate", "fastq_1")


def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Typed sample sheet; a malformed number, a missing required value or a bad format is an error."""
    given = spark.read.option("header", True).csv(path)
    missing = [c for c in REQUIRED if c not in given.columns]
    if missing:
        raise ValueError(f"sample sheet lacks columns {missing}")
    columns = []
    for field in SAMPLE_SHEET.fields:
        name = field.name
        text = F.trim(F.col(name)) if name in given.columns else F.lit(None).cast("string")
        text = F.when(text != "", text)
        complaint = F.raise_error(F.concat(F.lit(f"bad {name}: "), F.coalesce(text, F.lit("(empty)"))))
        if isinstance(field.dataType, T.IntegerType):
            wrong = text.isNotNull() & ~text.rlike(r"^-?\d+$")
        else:
            wrong = text.isNotNull() & ~text.rlike(FORMATS[name])
        if name in REQUIRED:
            wrong = wrong | text.isNull()
        columns.append(F.when(wrong, complaint).otherwise(text).try_cast(field.dataType).alias(name))
    return given.select(*columns)


def read_signal(spark: SparkSession, path: str, grp: str) -> DataFrame:
    """Signal table from text ``#chromosome start end <sample> ..``; plain, gzip or bgzip.

    Value columns take the order of the header.  A line with too few or malformed values fails the
    read; lines without any text end up nowhere.
    """
    lines = split_lines(spark, [path])
    names = _header(lines, path)[3:]
    values = value_names(len(names))
    columns = T.StructType([
        T.StructField("chrom", T.StringType()), T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()),
        *[T.StructField(v, T.DoubleType()) for v in values]])
    rows = lines.filter((F.col("line") != "") & ~F.col("line").startswith("#")).select(F.from_csv(
        "line", columns.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
        {"sep": "\t", "mode": "FAILFAST"}).alias("r")).select("r.*")
    short = F.col(values[-1]).isNull() if values else F.lit(True)
    checked = F.when(short, F.raise_error(F.lit("line with fewer values than the header"))).otherwise(F.col("chrom"))
    return rows.select(F.lit(grp).alias("grp"), checked.alias("chrom"), "start", "stop", *values)


def header_of(spark: SparkSession, path: str) -> list[str]:
    return _header(split_lines(spark, [path]), path)


def _header(lines: DataFrame, path: str) -> list[str]:
    first = lines.filter(F.col("line").startswith("#chromosome")).select("line").first()
    if first is None:
        raise ValueError(f"no header in {path}")
    return first.line.rstrip().split("\t")


def read_histogram(spark: SparkSession, path: str, grp: str) -> DataFrame:
    """Value histogram ``(grp, total, mean, cnt)`` from text ``sum mean count``."""
    columns = T.StructType([
        T.StructField("total", T.DoubleType()), T.StructField("mean", T.DoubleType()), T.StructField("cnt", T.LongType())])
    rows = spark.read.schema(columns).option("sep", "\t").option("header", True).option("enforceSchema", True).csv(path)
    return rows.select(F.lit(grp).alias("grp"), "total", "mean", "cnt")


def read_sites(spark: SparkSession, path: str, layout: T.StructType, keys: tuple[str, ...] = ("grp", "chrom", "pos")) -> DataFrame:
    """Site table written by ``sinks.write_sites``; vectors are JSON text in the file, never evaluated.

    ``layout`` is the schema the table had.  A site listed twice is an error.
    """
    flat = T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.ArrayType) else f.dataType) for f in layout])
    rows = spark.read.schema(flat).option("sep", "\t").option("header", True).option("enforceSchema", True).option(
        "mode", "FAILFAST").option("escape", '"').csv(path)
    vectors = [f for f in layout if isinstance(f.dataType, T.ArrayType)]
    rows = rows.withColumns({f.name: F.from_json(F.col(f"`{f.name}`"), f.dataType) for f in vectors}) if vectors else rows
    twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"site listed twice: {twice[0].asDict()}")
    return rows


def read_site_lists(spark: SparkSession, paths: Sequence[str], layout: T.StructType,
                    keys: tuple[str, ...] = ("identifier", "concentration", "chrom", "pos")) -> DataFrame:
    """Site lists of several concentrations together, each file with ``#key=value`` head lines.

    ``layout`` is the schema of the columns below the heads.  The heads are a side table, one row per file, joined to
    the rows by path.  A file without identifier, concentration or the columns of ``layout`` is an error, as are two
    lists (files or folders) of one concentration of an identifier, and a site listed twice.
    """
    lines = stage(split_lines(spark, paths).select("path", "line"), "site-lines")
    flat = T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.ArrayType) else f.dataType) for f in layout])
    names = "\t".join(flat.names)
    value = lambda key: F.max(F.when(F.col("line").startswith(f"#{key}="), F.substring_index("line", "=", -1)))
    heads = lines.groupBy("path").agg(
        value("identifier").alias("identifier"), value("concentration").try_cast("int").alias("concentration"),
        F.count_if(F.col("line") == names).alias("_heads"))
    wrong = F.when(F.col("identifier").isNull() | F.col("concentration").isNull(), "no identifier or concentration").when(
        F.col("_heads") != 1, "other columns than expected")
    named = F.regexp_replace("path", r"/part-[^/]*$", "")
    heads = stage(heads.select("path", "identifier", "concentration", named.alias("_list"), wrong.alias("_wrong")), "site-heads")
    # As many rows as files.
    bad = heads.filter("_wrong is not null").select("path", "_wrong").first()
    if bad:
        raise ValueError(f"site list {bad.path}: {bad['_wrong']}")
    lists = heads.groupBy("identifier", "concentration").agg(F.countDistinct("_list").alias("_n")).filter("_n > 1").first()
    if lists:
        raise ValueError(f"more than one site list for {lists.identifier} at concentration {lists.concentration}")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in flat)
    rows = lines.filter((F.col("line") != "") & ~F.col("line").startswith("#") & (F.col("line") != names)).select(
        "path", F.from_csv("line", kinds, {"sep": "\t", "mode": "FAILFAST", "escape": '"'}).alias("r"))
    vectors = {f.name: f.dataType for f in layout if isinstance(f.dataType, T.ArrayType)}
    cells = [F.from_json(F.col(f"r.`{c}`"), vectors[c]).alias(c) if c in vectors else F.col(f"r.`{c}`") for c in flat.names]
    found = rows.join(bounded_side(heads.select("path", "identifier", "concentration")), "path").select(
        "identifier", "concentration", *cells)
    twice = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").first()
    if twice:
        raise ValueError(f"site listed twice: {twice.asDict()}")
    return found


# -- reports of outside tools -------------------------------------------------------------------


def read_filter_report(spark: SparkSession, path: str, paired: bool = True) -> DataFrame:
    """Read-filter JSON; counts are halved to pairs for paired data."""
    columns = T.StructType([
        T.StructField("summary", T.StructType([T.StructField("before_filtering", T.StructType([
            T.StructField("total_reads", T.LongType()), T.StructField("q30_rate", T.DoubleType())]))])),
        T.StructField("filtering_result", T.StructType([T.StructField(c, T.LongType()) for c in (
            "passed_filter_reads", "low_quality_reads", "too_many_N_reads", "too_short_reads")])),
    ])
    unit = 2 if paired else 1
    result = "filtering_result"
    fields = {
        "total_reads": "summary.before_filtering.total_reads", "lowq_reads": f"{result}.low_quality_reads",
        "too_many_n_reads": f"{result}.too_many_N_reads", "short_reads": f"{result}.too_short_reads",
        "reads_passing_filter": f"{result}.passed_filter_reads"}
    return _report(spark, path, columns).select(
        _source(), *[F.expr(f"{column} div {unit}").alias(name) for name, column in fields.items()],
        (F.lit(100.0) * F.col("summary.before_filtering.q30_rate")).alias("pct_q30_reads_pf"))


def read_umi_report(spark: SparkSession, path: str) -> DataFrame:
    columns = T.StructType([
        *[T.StructField(c, T.LongType()) for c in ("total_reads", "passing_reads", "failing_reads")],
        T.StructField("passing_percentage", T.DoubleType())])
    return _report(spark, path, columns).select(_source(), "total_reads", "passing_reads", "failing_reads", "passing_percentage")


def read_count_report(spark: SparkSession, path: str) -> DataFrame:
    filters = T.StructType([T.StructField(c, T.LongType()) for c in (
        "low_mapping_quality", "above_clipping", "below_ref_length")])
    columns = T.StructType([
        *[T.StructField(c, T.LongType()) for c in ("total_reads", "passing_reads", "total_sites")],
        T.StructField("filters", filters)])
    return _report(spark, path, columns).select(_source(), "total_reads", "passing_reads", "total_sites", "filters.*")


def _report(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    return spark.read.schema(columns).option("multiLine", True).json(path)


def _source():
    return F.col("_metadata.file_path").alias("source")


def read_aligner_log(spark: SparkSession, path: str) -> DataFrame:
    """Aligned reads from the aligner's summary lines, one row per log file."""
    line = F.trim("value")
    total = F.when(line.endswith(" reads; of these:"), F.regexp_extract(line, r"^(\d+)", 1).try_cast("long"))
    unaligned = F.when(line.endswith(" aligned 0 times"), F.regexp_extract(line, r"^(\d+)", 1).try_cast("long"))
    seen = spark.read.text(path).groupBy(_source()).agg(F.max(total).alias("input_reads"), F.max(unaligned).alias("_un"))
    aligned = F.when(F.col("input_reads").isNull() | F.col("_un").isNull(), F.raise_error(
        F.concat(F.lit("no alignment summary in "), F.col("source")))).otherwise(F.col("input_reads") - F.col("_un"))
    return seen.select("source", "input_reads", aligned.alias("aligned_reads"))


def read_dedup_log(spark: SparkSession, path: str) -> DataFrame:
    """Alignments before and after duplicate removal, one row per log file."""
    before = F.regexp_extract("value", r"Reads: Input Reads: (\d+)", 1)
    after = F.regexp_extract("value", r"Number of reads out: (\d+)", 1)
    seen = spark.read.text(path).groupBy(_source()).agg(
        F.max(F.when(before != "", before.try_cast("long"))).alias("total_umis"),
        F.max(F.when(after != "", after.try_cast("long"))).alias("total_dedup_umis"))
    total = F.when(F.col("total_umis").isNull() | F.col("total_dedup_umis").isNull(), F.raise_error(
        F.concat(F.lit("no duplicate summary in "), F.col("source")))).otherwise(F.col("total_umis"))
    pct = F.when(F.col("total_umis") > 0, F.lit(100.0) * (F.col("total_umis") - F.col("total_dedup_umis")) / F.col("total_umis"))
    return seen.select("source", total.alias("total_umis"), "total_dedup_umis", pct.alias("pct_duplication"))
