"""Views of the given tables in the shape the operators expect.

The given tables hold no genomics.  Positions, samples, qualities and sequences are derived from
their columns row by row; the same expressions are written as SQL in ``oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPS = (1, 2, 3)
CONTROL = "0"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read starts ``(grp, chrom, pos, rep)``: group 0 is the control, 64 and 256 are tests."""
    item = table(spark, sf_dir, "lineitem")
    return item.select(
        F.expr("case l_returnflag when 'R' then '0' when 'A' then '64' else '256' end").alias("grp"),
        F.expr("concat('chr', l_suppkey % 4)").alias("chrom"),
        F.expr(
            "case when l_returnflag <> 'R' and l_partkey % 10 = 0 "
            "then (l_orderkey - l_orderkey % 500) * 7 + l_partkey % 3 "
            "else l_orderkey * 7 + l_partkey % 3 end"
        ).alias("pos"),
        F.expr("l_linenumber % 3 + 1").alias("rep"),
    )


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locuswave.operators.reads import merge_replicates

    return merge_replicates(reads(spark, sf_dir).withColumn("n", F.lit(1).cast("long")), REPS)


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SAM-like rows with clips, indels, secondary flags and UMIs."""
    item = table(spark, sf_dir, "lineitem")
    return item.select(
        F.expr("concat(l_returnflag, '_R', l_linenumber % 3 + 1)").alias("sample_id"),
        F.expr("concat(l_orderkey, '-', l_linenumber, '-', l_partkey)").alias("read_id"),
        F.expr("concat('chr', l_suppkey % 4)").alias("chrom"),
        F.expr("(l_orderkey - l_orderkey % 64) * 7 + l_partkey % 3").alias("pos"),
        F.expr(
            "cast((case when l_linestatus = 'O' then 16 else 0 end) + "
            "(case when l_partkey % 17 = 0 then 256 else 0 end) as int)"
        ).alias("flag"),
        F.expr("cast(l_quantity as int)").alias("mapq"),
        F.expr(
            "concat(case when l_linenumber % 4 > 0 and l_suppkey % 3 = 0 "
            "       then concat(l_linenumber % 4, 'S') else '' end,"
            "       10 + l_partkey % 30, 'M', l_linenumber, 'D', 2, 'I', 5, 'M',"
            "       case when l_suppkey % 5 = 0 then '3S' else '' end)"
        ).alias("cigar"),
        F.expr(
            "concat('ACG', substring('ACGT', cast(l_partkey % 4 + 1 as int), 1),"
            "       substring('AC', cast(l_partkey div 4 % 2 + 1 as int), 1), 'TT')"
        ).alias("umi"),
    )


def crowded_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments at a few places with thousands of UMIs of six letters each, in very uneven numbers."""
    item = table(spark, sf_dir, "lineitem")
    return item.select(
        F.expr("concat(l_linestatus, '_R1')").alias("sample_id"),
        F.expr("concat(l_orderkey, '-', l_linenumber, '-', l_partkey)").alias("read_id"),
        F.expr("concat('chr', l_suppkey % 2)").alias("chrom"), F.lit(1000).cast("long").alias("pos"),
        F.lit(0).alias("flag"), F.expr("cast(l_quantity as int)").alias("mapq"), F.lit("50M").alias("cigar"),
        F.expr("translate(substring(md5(cast(l_partkey % 997 * (l_partkey % 13) as string)), 1, 5), '0123456789abcdef', "
               "'ACGTACGTACGTACGT') || substring('ACGT', cast(l_orderkey % 7 % 4 + 1 as int), 1)").alias("umi"))


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test groups, their control and on-target, read off the table's flags (one row per flag)."""
    flags = table(spark, sf_dir, "lineitem").select("l_returnflag").distinct().filter("l_returnflag <> 'R'")
    return flags.select(
        F.lit("guide").alias("sample_group"),
        F.expr("case l_returnflag when 'A' then 64 else 256 end").alias("conc"),
        F.expr("case l_returnflag when 'A' then '64' else '256' end").alias("grp"),
        F.lit(CONTROL).alias("control_grp"),
        F.lit(ON_TARGET_MOTIF).alias("on_target_motif"), F.lit(ON_TARGET_LOCATION).alias("on_target_location"),
    )


ON_TARGET_MOTIF = "GACGTCTTNGG"
ON_TARGET_LOCATION = "chr1:41,995-42,005,+"
CHUNK = 224


def genome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four contigs with seven bases per order, in chunks of 32 orders: ``(chrom, chunk_id, seq)``."""
    order = table(spark, sf_dir, "orders")
    bases = order.select(
        F.expr("explode(sequence(0, 3))").alias("c"), F.col("o_orderkey").alias("k"),
    ).select(
        F.expr("concat('chr', c)").alias("chrom"), F.expr("k div 32").alias("chunk_id"), "k",
        F.expr("substring(translate(md5(concat(k, '-', c)), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 7)").alias("b"),
    )
    # 32 orders per chunk by construction.
    seq = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "b"))), lambda p: p["b"]), "")
    return bases.groupBy("chrom", "chunk_id").agg(seq.alias("seq"))


def genome_with_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same genome with the guide's own sequence at the on-target location, bases 41,994 to 42,004 from zero."""
    cell, at = 41_994 // CHUNK, 41_994 % CHUNK
    planted = F.expr(f"concat(substring(seq, 1, {at}), 'GACGTCTTAGG', substring(seq, {at + 12}))")
    here = (F.col("chrom") == "chr1") & (F.col("chunk_id") == cell)
    return genome(spark, sf_dir).withColumn("seq", F.when(here, planted).otherwise(F.col("seq")))


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = table(spark, sf_dir, "orders")
    longest = order.agg((F.max("o_orderkey") * 7 + 7).alias("length"))
    each = longest.select(F.explode(F.sequence(F.lit(0), F.lit(3))).alias("c"), "length")
    return each.select(F.concat(F.lit("chr"), "c").alias("chrom"), "length")


def read_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read pairs from documents: bases and qualities from the text, whole texts, one pair each."""
    doc = table(spark, sf_dir, "documents")
    return doc.select(
        F.expr("concat('D_R', doc_id % 3 + 1)").alias("sample_id"), F.col("doc_id").cast("string").alias("read_id"),
        F.expr("translate(md5(text), '0123456789abcdef', 'ACGTACGTACGTACGN')").alias("seq1"),
        F.expr("translate(md5(reverse(text)), '0123456789abcdef', 'ACGTACGTACGTACGN')").alias("seq2"),
        F.expr("translate(md5(concat(text, '1')), '0123456789abcdef', '+05?CFIIIIIIIIII')").alias("qual1"),
        F.expr("translate(md5(concat(text, '2')), '0123456789abcdef', '+05?CFIIIIIIIIII')").alias("qual2"),
    )


def overlapping_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of 60 bases from fragments of 20 to 109 bases with adapters behind, some bases changed, some reads short."""
    doc = table(spark, sf_dir, "documents").withColumn("fragment", F.expr(
        "substring(translate(concat(md5(text), md5(concat(text, 'a')), md5(concat(text, 'b')), md5(concat(text, 'c'))), "
        "'0123456789abcdef', 'ACGTACGTACGTACGT'), 1, cast(20 + doc_id % 90 as int))"))
    doc = doc.withColumn("turned", F.expr("translate(reverse(fragment), 'ACGT', 'TGCA')"))
    size = "cast(case when doc_id % 13 = 0 then 5 when doc_id % 11 = 0 then 48 else 60 end as int)"
    return doc.withColumn("s", F.expr("substring(concat(turned, repeat('AGATCGGAAGAGCGT', 4)), 1, 60)")).select(
        F.expr("concat('D_R', doc_id % 3 + 1)").alias("sample_id"), F.col("doc_id").cast("string").alias("read_id"),
        F.expr(f"substring(concat(fragment, repeat('AGATCGGAAGAGCAC', 4)), 1, {size})").alias("seq1"),
        # Every base of one kind in a stretch becomes N in some reads: up to and beyond the mismatch bound.
        F.expr("case when doc_id % 4 = 0 then concat(translate(substring(s, 1, cast(doc_id % 37 as int)), 'A', 'N'), "
               "substring(s, cast(doc_id % 37 + 1 as int))) else s end").alias("seq2"),
        F.expr(f"repeat('I', {size})").alias("qual1"), F.expr("repeat('I', 60)").alias("qual2"))


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of 1-based coordinates, one pair per line item."""
    item = table(spark, sf_dir, "lineitem")
    return item.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.expr("concat('chr', l_suppkey % 2)").alias("chrom_a"), F.expr("concat('chr', l_suppkey % 3 % 2)").alias("chrom_b"),
        F.expr("100 + l_partkey % 50").alias("start_a"), F.expr("110 + l_partkey % 50 + l_linenumber").alias("stop_a"),
        F.expr("100 + l_orderkey % 60").alias("start_b"), F.expr("105 + l_orderkey % 60 + l_linenumber").alias("stop_b"),
        F.expr("l_linestatus = 'O'").alias("rev_a"), F.expr("l_returnflag = 'R'").alias("rev_b"),
    )


def sample_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample sheet read off the table: one sample per flag and line number."""
    item = table(spark, sf_dir, "lineitem")
    return item.select("l_returnflag", "l_linenumber").distinct().select(
        F.expr("case l_returnflag when 'R' then 'ctrl' when 'A' then 'guideA' else 'guideN' end").alias("sample_group"),
        F.expr("case l_returnflag when 'R' then '' else 'ctrl' end").alias("control_group"),
        F.expr("case when l_returnflag = 'R' then 0 when l_linenumber <= 3 then 64 else 256 end").alias("concentration"),
        F.expr("l_linenumber").alias("replicate"),
        F.expr("case when l_returnflag = 'R' then '' else 'GACGTCTTNGG' end").alias("on_target_motif"),
        F.expr("case when l_returnflag = 'R' then '' else 'chr1:41,995-42,005,+' end").alias("on_target_location"),
        F.expr("concat('reads/', l_returnflag, l_linenumber, '_1.fastq.gz')").alias("fastq_1"),
        F.expr("concat('reads/', l_returnflag, l_linenumber, '_2.fastq.gz')").alias("fastq_2"),
    )


def faulty_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large sample sheet, a row per order, in which every rule is broken somewhere."""
    order = table(spark, sf_dir, "orders")
    control, group = "o_custkey % 4 = 0", "o_custkey % 4 > 0"
    motif = "case when o_custkey % 23 = 5 and o_orderkey % 2 = 0 then 'ACGTNGG' else 'GACGTCTTNGG' end"
    return order.select(
        F.expr(f"case when {control} then concat('ctl', o_custkey % 1024) else concat('g', o_custkey % 1021) end").alias("sample_group"),
        F.expr(f"case when {group} and o_custkey % 37 = 3 then '' when {group} then concat('ctl', o_custkey % 1021 % 300 * 4) "
               "when o_custkey % 52 = 0 then 'ctl4' else '' end").alias("control_group"),
        F.expr(f"case when o_custkey % 61 = 1 and o_orderkey % 3 = 0 then -1 when {control} then 0 "
               "else 16 + 48 * (o_custkey % 3) end").alias("concentration"),
        F.expr("cast(o_orderkey % (2 + o_custkey % 3) as int)").alias("replicate"),
        F.expr(f"case when {group} then {motif} else '' end").alias("on_target_motif"),
        F.expr(f"case when {group} then 'chr1:41,995-42,005,+' else '' end").alias("on_target_location"),
        F.lit("a_1.fastq.gz").alias("fastq_1"),
        F.expr("case when o_custkey % 19 = 0 or o_orderkey % 29 = 0 then null else 'a_2.fastq.gz' end").alias("fastq_2"))


def trading_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large grouping table: one sample per order, customers as sample groups, nations as controls."""
    order, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return order.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.expr("concat('c', o_custkey)").alias("sample_group"),
        F.expr("case when c_mktsegment = 'BUILDING' then cast(null as string) else concat('n', c_nationkey) end").alias("control_group"),
        F.expr("case when c_mktsegment = 'BUILDING' then 0 else 64 end").alias("concentration"),
        F.col("o_orderkey").alias("replicate"),
    )
