"""CIGAR strings as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# SAM flag bits.
REVERSE = 0x10
UNMAPPED, SECONDARY, SUPPLEMENTARY = 0x4, 0x100, 0x800


def reference_length(cigar: Column) -> Column:
    """Bases of the reference covered: operations M, D, N, = and X."""
    lengths = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), 1)
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda acc, x: acc + x.cast("long"))


def five_prime_clip(cigar: Column, flag: Column) -> Column:
    """Clipped bases at the start of the read, which is the right end of a reverse alignment."""
    left = F.regexp_extract(cigar, r"^(\d+)[SH]", 1)
    right = F.regexp_extract(cigar, r"(\d+)[SH]$", 1)
    text = F.when(is_reverse(flag), right).otherwise(left)
    return F.when(text == "", F.lit(0)).otherwise(text).cast("int")


def is_reverse(flag: Column) -> Column:
    return flag.bitwiseAND(REVERSE) != 0


def is_primary(flag: Column) -> Column:
    return flag.bitwiseAND(UNMAPPED | SECONDARY | SUPPLEMENTARY) == 0


def read_start(pos: Column, flag: Column, ref_length: Column) -> Column:
    return F.when(is_reverse(flag), pos + ref_length - 1).otherwise(pos)
