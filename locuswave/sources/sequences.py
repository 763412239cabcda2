"""FASTQ pairs, SAM text, FASTA genomes and their indexes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locuswave.files import plain_path
from locuswave.schema import ALIGNMENTS, CONTIGS
from locuswave.sources.bgzf import SPLIT_BYTES
from locuswave.sources.text_lines import numbered_lines, split_lines


def read_fastq(spark: SparkSession, sheet: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Read pairs ``(sample_id, read_id, seq1, qual1, seq2, qual2)`` of a sample sheet.

    Lanes of a sample are added up.  Records of the two files are paired by their ordinal and end
    with the shorter file; single-end samples have NULL second reads.  Pairing and the assembly of
    the four lines of a record take one shuffle together.
    """
    files = sheet.select("sample_id", F.col("fastq_1").alias("path"), F.lit(1).alias("mate"), F.col("fastq_1").alias("lane"))
    paired = "fastq_2" in sheet.columns
    if paired:
        files = files.unionByName(sheet.filter("fastq_2 is not null").select(
            "sample_id", F.col("fastq_2").alias("path"), F.lit(2).alias("mate"), F.col("fastq_1").alias("lane")))
    # The sample sheet names every file, so the list is as short as the sheet.
    paths = [r.path for r in files.select("path").distinct().collect()]
    lines = numbered_lines(spark, paths, split_bytes).join(
        F.broadcast(files.withColumn("path", plain_path(F.col("path")))), "path")
    part = F.col("line_no") % 4

    def text(mate: int, line: int):
        return F.max(F.when((F.col("mate") == mate) & (part == line), F.col("line")))

    records = lines.groupBy("sample_id", "lane", F.expr("line_no div 4").alias("record")).agg(
        text(1, 0).alias("name"), text(1, 1).alias("seq1"), text(1, 3).alias("qual1"),
        text(2, 1).alias("seq2"), text(2, 3).alias("qual2"))
    rows = records.filter(F.col("qual1").isNotNull())
    if paired:
        mates = files.filter("mate = 2").select("sample_id", "lane", F.lit(True).alias("has_mate")).distinct()
        rows = rows.join(F.broadcast(mates), ["sample_id", "lane"], "left").filter("has_mate is null or qual2 is not null")
    read_id = F.substring_index(F.regexp_replace("name", "^@", ""), " ", 1)
    return rows.select("sample_id", read_id.alias("read_id"), "seq1", "qual1", "seq2", "qual2")


def read_sam(spark: SparkSession, sample_id: str, paths: str | Sequence[str], umi_separator: str = "_") -> DataFrame:
    """Alignments from SAM text (plain, gzip or bgzip): 0-based positions, UMI from the end of the read name."""
    fields = F.split(F.col("line"), "\t")
    chrom = fields[2]
    return (
        split_lines(spark, [paths] if isinstance(paths, str) else paths)
        .filter(~F.col("line").startswith("@") & (F.col("line") != ""))
        .select(
            F.lit(sample_id).alias("sample_id"), fields[0].alias("read_id"),
            F.when(chrom != "*", chrom).alias("chrom"), (fields[3].cast("long") - 1).alias("pos"),
            fields[1].cast("int").alias("flag"), fields[4].cast("int").alias("mapq"), fields[5].alias("cigar"),
            F.when(fields[0].contains(umi_separator), F.substring_index(fields[0], umi_separator, -1)).alias("umi"))
        .to(ALIGNMENTS)
    )


def read_fai(spark: SparkSession, path: str) -> DataFrame:
    """Contig lengths from a FASTA index."""
    columns = T.StructType([*CONTIGS.fields, *[T.StructField(c, T.LongType()) for c in ("offset", "bases", "width")]])
    return spark.read.schema(columns).option("sep", "\t").csv(path).select("chrom", "length")


def contigs_of(genome: DataFrame, chunk: int) -> DataFrame:
    """Contig lengths from a chunked genome table."""
    return genome.groupBy("chrom").agg(F.max(F.col("chunk_id") * chunk + F.length("seq")).alias("length"))


def read_fasta(spark: SparkSession, paths: str | Sequence[str], chunk: int = 4096,
               split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Genome as ``(chrom, chunk_id, seq)`` with ``chunk`` bases per row, the last of a contig shorter.

    Headers and base offsets are carried over splits by one summary row per split.
    """
    lines = numbered_lines(spark, [paths] if isinstance(paths, str) else paths, split_bytes)
    is_header = F.col("line").startswith(">")
    name = F.regexp_extract("line", r"^>(\S+)", 1)
    lines = lines.select(
        "path", "split", "line_no", "line", is_header.alias("header"), F.when(is_header, name).alias("name"),
        F.when(is_header, 0).otherwise(F.length(F.trim("line"))).cast("long").alias("bases"))

    in_split = Window.partitionBy("path", "split").orderBy("line_no")
    upto = in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = lines.select(
        "*", F.last("name", ignorenulls=True).over(upto).alias("_name"), F.sum("bases").over(upto).alias("_sum"))
    local = local.withColumn("_base", F.last(F.when(F.col("header"), F.col("_sum")), ignorenulls=True).over(upto))

    summary = local.groupBy("path", "split").agg(
        F.max_by("_name", "line_no").alias("_name"), F.max_by("_sum", "line_no").alias("_sum"),
        F.max_by("_base", "line_no").alias("_base"))
    over_splits = Window.partitionBy("path").orderBy("split")
    so_far = over_splits.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = over_splits.rowsBetween(Window.unboundedPreceding, -1)
    # Bases after the last header; without a header the whole split adds to the open contig.
    tail = F.col("_sum") - F.coalesce("_base", F.lit(0))
    summary = summary.withColumn("_tail", tail).withColumn("_headers", F.count("_name").over(so_far))
    open_contig = Window.partitionBy("path", "_headers").orderBy("split").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summary = summary.withColumn("_open", F.sum("_tail").over(open_contig))
    carry = summary.select(
        "path", "split", F.last("_name", ignorenulls=True).over(before).alias("carry_name"),
        F.coalesce(F.lag("_open").over(over_splits), F.lit(0)).alias("carry_bases"))

    placed = local.filter("not header and bases > 0").join(carry, ["path", "split"]).select(
        F.coalesce("_name", "carry_name").alias("chrom"), F.trim("line").alias("text"), "bases",
        (F.col("_sum") - F.col("bases") - F.coalesce("_base", F.lit(0))
         + F.when(F.col("_name").isNull(), F.col("carry_bases")).otherwise(F.lit(0))).alias("at"))
    cells = F.sequence(F.expr(f"at div {chunk}"), F.expr(f"(at + bases - 1) div {chunk}"))
    start = F.greatest(F.col("chunk_id") * chunk - F.col("at"), F.lit(0))
    length = F.least(F.col("at") + F.col("bases"), (F.col("chunk_id") + 1) * chunk) - F.col("at") - start
    pieces = placed.withColumn("chunk_id", F.explode(cells)).select(
        "chrom", "chunk_id", "at", F.substring(F.col("text"), (start + 1).cast("int"), length.cast("int")).alias("piece"))
    # A chunk is made of about chunk / line-width pieces.
    seq = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda p: p["piece"]), "")
    return pieces.groupBy("chrom", "chunk_id").agg(seq.alias("seq"))
