"""Read-start counts while alignments are still arriving.

The same filter and aggregation as the batch operator, on a stream of alignment files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from locuswave.operators.reads import classify, read_start_counts
from locuswave.params import Params
from locuswave.schema import ALIGNMENTS


def arriving_alignments(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Parquet files in the alignment layout, as they land in ``folder``."""
    return (
        spark.readStream.schema(ALIGNMENTS).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    )


def running_counts(alignments: DataFrame, params: Params) -> DataFrame:
    """Counts so far per sample and position; state holds one row per counted position."""
    return read_start_counts(classify(alignments, params))


def write_counts(counts: DataFrame, table: str, checkpoint: str):
    """Start a query that appends each batch's changed counts to ``table`` with its batch number.

    The latest batch number of a position carries its count.  A batch that is run again after a
    failure overwrites its own partition.
    """
    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={number}")

    return (
        counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(save).start()
    )


def latest_counts(spark: SparkSession, table: str) -> DataFrame:
    rows = spark.read.parquet(table)
    return rows.groupBy("sample_id", "chrom", "pos").agg({"n": "max"}).withColumnRenamed("max(n)", "n")
