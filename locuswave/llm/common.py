"""Helpers shared by the text operators: tables, word arrays and window hashes as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words of the contracts are runs of anything but these six white-space characters.
BREAKS = "\t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(text: Column, characters: str, put: str = "") -> Column:
    """Replaces each of a few characters; a byte search each, much faster than a pattern over the text."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(put)), characters, text)


def spaced(text: Column) -> Column:
    """The text with every white-space character as a blank; NULL becomes the empty text."""
    return without(F.coalesce(text, F.lit("")), BREAKS, " ")


def words_of(blanked: Column) -> Column:
    """Array of the words of a text that ``spaced`` has made."""
    return F.filter(F.split(blanked, " "), lambda w: w != "")


def tail(array: Column, start: int) -> Column:
    """Elements from the 1-based position ``start`` on; empty when there are none."""
    return F.slice(array, F.lit(start), F.greatest(F.size(array) - (start - 1), F.lit(0)))


def window_hashes(ids: Column, width: int) -> Column:
    """64-bit hash of each run of ``width`` word hashes, in order; empty for shorter texts."""
    return F.when(F.size(ids) >= width, F.transform(
        F.sequence(F.lit(0), F.size(ids) - width),
        lambda i: F.xxhash64(*[F.get(ids, i + k) for k in range(width)]))).otherwise(
            F.array().cast("array<bigint>"))
