"""Nucleotide strings and read qualities as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# IUPAC codes with their complements and the bases they stand for.
CODES = "ACGTRYSWKMBVDHN"
COMPLEMENTS = "TGCAYRSWMKVBHDN"
IUPAC = {
    "A": "A", "C": "C", "G": "G", "T": "T",
    "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC",
    "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT",
}


def reverse_complement(seq: Column) -> Column:
    """Reverse complement over the IUPAC codes, case kept; any other letter is an error."""
    known = seq.rlike(f"^[{CODES}{CODES.lower()}-]*$")
    turned = F.reverse(F.translate(seq, CODES + CODES.lower(), COMPLEMENTS + COMPLEMENTS.lower()))
    bad = F.raise_error(F.concat(F.lit("not a nucleotide sequence: "), seq))
    return F.when(seq.isNull() | known, turned).otherwise(bad)


def reverse_complement_text(seq: str) -> str:
    table = str.maketrans(CODES + CODES.lower(), COMPLEMENTS + COMPLEMENTS.lower())
    return seq.translate(table)[::-1]


def base_mask(code: str) -> int:
    """Bases of an IUPAC code as bits; two codes match when their masks share a bit."""
    return sum(1 << "ACGT".index(base) for base in IUPAC.get(code.upper(), ""))


def motif_regex(motif: str) -> str:
    """Regular expression for an exact (degenerate) occurrence."""
    return "".join(f"[{IUPAC[code]}]" for code in motif.upper())


def matches_at(motif: str, seq: Column, offset: Column) -> Column:
    """Matching positions of an ungapped motif laid on ``seq`` at a 0-based offset."""
    hits = [
        F.substring(seq, offset + i + 1, F.lit(1)).isin(*IUPAC[code]).cast("int")
        for i, code in enumerate(motif.upper())
    ]
    return sum(hits[1:], hits[0])


def low_quality_bases(qual: Column, length: int, threshold: int) -> Column:
    """Bases below ``threshold`` among the first ``length`` of a Phred+33 string."""
    head = F.split(F.substring(qual, 1, length), "")
    low = F.filter(head, lambda c: (c != "") & (F.ascii(c) - 33 < threshold))
    return F.size(low)


def umi_passes(qual: Column, length: int, threshold: int, max_low: int) -> Column:
    """UMI quality rule: at most ``max_low`` low bases; an empty quality string fails."""
    enough = low_quality_bases(qual, length, threshold) <= max_low
    return F.coalesce((F.length(qual) > 0) & enough, F.lit(False))


def base_name(path: Column) -> Column:
    """File name up to its first dot."""
    return F.substring_index(F.substring_index(path, "/", -1), ".", 1)


def is_compressed(path: Column) -> Column:
    return path.rlike(r"\.(gz|bgz)$")
