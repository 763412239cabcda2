"""Row layouts.

Signal tables hold one flat numeric column per replicate (``v1 .. vn``) rather than an array:
flat columns stay inside whole-stage code generation, arrays and their lambdas do not.
``vectorize`` turns them into the published ``vals array<double>`` form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_SHEET = T.StructType([
    T.StructField("sample_group", T.StringType()),
    T.StructField("control_group", T.StringType()),
    T.StructField("concentration", T.IntegerType()),
    T.StructField("replicate", T.IntegerType()),
    T.StructField("on_target_motif", T.StringType()),
    T.StructField("on_target_location", T.StringType()),
    T.StructField("fastq_1", T.StringType()),
    T.StructField("fastq_2", T.StringType()),
])

ALIGNMENTS = T.StructType([
    T.StructField("sample_id", T.StringType()),
    T.StructField("read_id", T.StringType()),
    T.StructField("chrom", T.StringType()),
    T.StructField("pos", T.LongType()),
    T.StructField("flag", T.IntegerType()),
    T.StructField("mapq", T.IntegerType()),
    T.StructField("cigar", T.StringType()),
    T.StructField("umi", T.StringType()),
])

CONTIGS = T.StructType([
    T.StructField("chrom", T.StringType()),
    T.StructField("length", T.LongType()),
])

# Exact arithmetic for normalised counts: ten decimals, like the text hand-off between stages.
EXACT = T.DecimalType(28, 10)


def value_names(n: int, prefix: str = "v") -> list[str]:
    return [f"{prefix}{k}" for k in range(1, n + 1)]


def add_all(columns: list[Column]) -> Column:
    total = columns[0]
    for column in columns[1:]:
        total = total + column
    return total


def total_of(n: int, prefix: str = "v") -> Column:
    return add_all([F.col(name) for name in value_names(n, prefix)])


def mean_of(n: int, prefix: str = "v") -> Column:
    return total_of(n, prefix).cast("double") / F.lit(n)


def vectorize(df: DataFrame, n: int, prefix: str = "v", name: str = "vals") -> DataFrame:
    names = value_names(n, prefix)
    vector = F.array(*[F.col(c).cast("double") for c in names]).alias(name)
    return df.select(*[c for c in df.columns if c not in names], vector)


def devectorize(df: DataFrame, n: int, name: str = "vals", prefix: str = "v") -> DataFrame:
    kept = [c for c in df.columns if c != name]
    return df.select(*kept, *[F.col(name)[k].alias(c) for k, c in enumerate(value_names(n, prefix))])
