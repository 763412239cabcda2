"""Writers of signal, histogram, site and metrics tables and of filtered reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuswave.files import listed
from locuswave.schema import value_names
from locuswave.sinks import files
from locuswave.sources.ranges import write_ranges


def write_signal(runs: DataFrame, path: str, parts: int | None = None) -> None:
    """Parquet, one folder per group, range-partitioned and sorted by coordinate, with an index of ranges.

    ``sources.ranges.read_region`` chooses files by the index; row-group minima and maxima prune inside them.
    """
    keys = ("grp", "chrom", "start")
    dealt = runs.repartitionByRange(parts, *keys) if parts else runs.repartitionByRange(*keys)
    dealt.sortWithinPartitions(*keys).write.partitionBy("grp").parquet(path)
    write_ranges(runs.sparkSession, path)


def write_signal_text(runs: DataFrame, samples: Sequence[str], path: str, digits: int = 10) -> None:
    """Gzipped text ``#chromosome start end <sample> ..``, ten decimals, sorted over the part files."""
    values = [F.format_string(f"%.{digits}f", F.col(v).cast("double")).alias(s)
              for v, s in zip(value_names(len(samples)), samples)]
    rows = runs.repartitionByRange("chrom", "start").sortWithinPartitions("chrom", "start").select(
        F.col("chrom").alias("#chromosome"), "start", F.col("stop").alias("end"), *values)
    # Without another comment sign the writer would quote the leading "#" of the header.
    rows.write.option("sep", "\t").option("header", True).option("comment", "~").option("compression", "gzip").csv(path)


def write_histogram(hist: DataFrame, path: str) -> None:
    """Text ``sum mean count`` by falling sum, one folder per group."""
    rows = hist.select("grp", F.col("total").alias("sum"), "mean", F.col("cnt").alias("count"))
    (
        rows.repartitionByRange(F.asc("grp"), F.desc("sum")).sortWithinPartitions(F.asc("grp"), F.desc("sum"))
        .write.partitionBy("grp").option("sep", "\t").option("header", True).csv(path)
    )


def as_text(df: DataFrame) -> DataFrame:
    """Arrays as JSON text, so that tables with vectors can be written as delimited text."""
    return df.select(*[
        F.to_json(F.col(f"`{c.name}`")).alias(c.name) if c.dataType.typeName() == "array" else F.col(f"`{c.name}`")
        for c in df.schema])


def write_sites(sites: DataFrame, path: str, order: Sequence[str]) -> None:
    """Site table as tab-separated text in rank order; identifier and concentration are columns."""
    rows = sites.repartitionByRange(*order).sortWithinPartitions(*order)
    as_text(rows).write.option("sep", "\t").option("header", True).option("escape", '"').csv(path)


def write_site_lists(sites: DataFrame, path: str, order: Sequence[str], identifier: str = "grp", concentration: str = "conc") -> None:
    """Site lists as published: a folder per group, files with ``#key=value`` head lines before the column names."""
    rows = as_text(sites.drop(identifier, concentration))
    names = "\t".join(rows.columns)
    text = as_text(sites)
    head = F.concat(F.lit("#identifier="), F.col(identifier), F.lit("\n#concentration="), F.col(concentration).cast("string"),
                    F.lit(f"\n{names}"))
    keys = [identifier, concentration, *order]
    dealt = text.repartitionByRange(*keys).sortWithinPartitions(*keys)
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"sep": "\t", "escape": '"'})
    files.write_blocked_gzip(dealt.select(
        files.folder_name(F.col(identifier)).alias("folder"), head.alias("head"), line.alias("line")), path, "tsv.gz")


def write_metrics(metrics: DataFrame, path: str) -> None:
    """All samples under one header; one row per sample, so one file."""
    metrics.orderBy("identifier").coalesce(1).write.option("sep", "\t").option("header", True).csv(path)


def write_reports(rows: DataFrame, path: str) -> None:
    """One JSON file per sample (filter and count reports), named by it."""
    files.write_named(rows.select(F.concat(files.folder_name(F.col("sample_id")), F.lit(".json")).alias("name"),
                                  F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("content")), path)


def count_report(stats: DataFrame) -> DataFrame:
    """Count statistics in the nested form of the published report."""
    return stats.select(
        "sample_id", "total_reads", "passing_reads", "total_sites",
        F.struct("low_mapping_quality", "above_clipping", "below_ref_length").alias("filters"))


def write_fastq(pairs: DataFrame, path: str, mates: Sequence[int] | None = None, umi_separator: str = "_") -> None:
    """Blocked-gzip FASTQ, a folder per sample and mate, a part file per task.

    Parts of the same number are a lane: they hold the same reads in the same order for every mate, so that
    ``fastq_sheet`` can pair them.  All mates that ``pairs`` has are written.  An extracted UMI goes behind the read
    name, where aligners keep it and ``read_sam`` finds it.
    """
    mates = [m for m in (1, 2) if f"seq{m}" in pairs.columns] if mates is None else mates
    name = F.concat_ws(umi_separator, "read_id", "umi") if "umi" in pairs.columns else F.col("read_id")
    records = [
        F.struct(F.lit(m).alias("mate"), F.concat_ws(
            "\n", F.concat(F.lit("@"), name), f"seq{m}", F.lit("+"), f"qual{m}").alias("record"))
        for m in mates]
    folder = F.concat(F.lit("sample_id="), files.folder_name(F.col("sample_id")), F.lit("/mate="), F.col("r.mate").cast("string"))
    rows = (
        pairs.select("sample_id", "read_id", F.array(*records).alias("records"))
        .repartitionByRange("sample_id", "read_id")
        .select("sample_id", "read_id", F.explode("records").alias("r"))
        .sortWithinPartitions("sample_id", "r.mate", "read_id", "r.record")
    )
    files.write_blocked_gzip(rows.select(folder.alias("folder"), F.col("r.record").alias("line")), path, "fastq.gz")


def fastq_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Lanes ``(sample_id, fastq_1, fastq_2)`` of what ``write_fastq`` wrote."""
    place = F.regexp_extract("path", r"sample_id=([^/]+)/mate=", 1)
    mate = F.regexp_extract("path", r"/mate=(\d+)/", 1)
    lane = F.regexp_extract("path", r"/(part-\d+[^/]*)$", 1)
    found = listed(spark, [path]).select(files.plain_name(place).alias("sample_id"), mate.alias("mate"), lane.alias("lane"), "path")
    return found.groupBy("sample_id", "lane").agg(
        F.max(F.when(F.col("mate") == "1", F.col("path"))).alias("fastq_1"),
        F.max(F.when(F.col("mate") == "2", F.col("path"))).alias("fastq_2")).drop("lane")
