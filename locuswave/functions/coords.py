"""Genomic coordinates as column expressions.

``Span`` holds four columns and whether positions are 1-based closed (``one_based``) or 0-based
half-open.  Everything stays inside Catalyst; nothing is evaluated on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coordinate text, "chr1:10-20,+" (1-based) or "chr1:9_20,+" (0-based).
ONE_BASED_TEXT = r"^([^:]+):([0-9]+)(?:-([0-9]+))?(?:,([+-]))?$"
ZERO_BASED_TEXT = r"^([^:]+):([0-9]+)(?:_([0-9]+))?(?:,([+-]))?$"


@dataclass(frozen=True)
class Span:
    chrom: Column
    start: Column
    stop: Column
    reverse: Column
    one_based: bool = True

    # -- construction ----------------------------------------------------------------------

    @classmethod
    def of(cls, chrom: Column, start: Column, stop: Column, reverse: Column, one_based: bool = True) -> "Span":
        """Swaps start and stop of a reverse span given right to left; an error on the forward strand."""
        ordered = (start <= stop) | reverse
        checked = F.when(ordered, F.least(start, stop)).otherwise(
            F.raise_error(F.lit("start is larger than stop")))
        return cls(chrom, checked, F.greatest(start, stop), reverse, one_based)

    @classmethod
    def parse(cls, text: Column, one_based: bool = True) -> "Span":
        """From text; thousands separators inside numbers are accepted, a missing stop means one position."""
        pattern = ONE_BASED_TEXT if one_based else ZERO_BASED_TEXT
        plain = F.regexp_replace(text, r"(?<=[0-9]),(?=[0-9])", "")
        first, second = F.regexp_extract(plain, pattern, 2), F.regexp_extract(plain, pattern, 3)
        start = F.when(plain.rlike(pattern), first).when(
            plain.isNotNull(), F.raise_error(F.concat(F.lit("not a coordinate: "), text))).cast("long")
        stop = F.when(second == "", start).otherwise(second.try_cast("long"))
        reverse = F.regexp_extract(plain, pattern, 4) == "-"
        return cls.of(F.regexp_extract(plain, pattern, 1), start, stop, reverse, one_based)

    @classmethod
    def unpack(cls, name: str, one_based: bool = True) -> "Span":
        part = lambda field: F.col(f"{name}.{field}")
        return cls(part("chrom"), part("start"), part("stop"), part("is_reverse_strand"), one_based)

    def pack(self) -> Column:
        return F.struct(
            self.chrom.alias("chrom"), self.start.alias("start"), self.stop.alias("stop"),
            self.reverse.alias("is_reverse_strand"))

    def _with(self, start: Column | None = None, stop: Column | None = None, **other) -> "Span":
        fields = dict(chrom=self.chrom, start=self.start if start is None else start,
                      stop=self.stop if stop is None else stop, reverse=self.reverse, one_based=self.one_based)
        return Span(**{**fields, **other})

    # -- measures and text -----------------------------------------------------------------

    def length(self) -> Column:
        return self.stop - self.start + (1 if self.one_based else 0)

    def text(self, stranded: bool = True) -> Column:
        separator = F.lit("-" if self.one_based else "_")
        body = F.concat(self.chrom, F.lit(":"), self.start.cast("string"), separator, self.stop.cast("string"))
        return F.concat(body, F.when(self.reverse, F.lit(",-")).otherwise(F.lit(",+"))) if stranded else body

    def boundary_5prime(self) -> Column:
        return F.when(self.reverse, self.stop).otherwise(self.start)

    def boundary_3prime(self) -> Column:
        return F.when(self.reverse, self.start).otherwise(self.stop)

    # -- changes ---------------------------------------------------------------------------

    def switch_strand(self) -> "Span":
        return self._with(reverse=~self.reverse)

    def extend_5prime(self, by: Column) -> "Span":
        return self._with(F.when(self.reverse, self.start).otherwise(self.start - by),
                          F.when(self.reverse, self.stop + by).otherwise(self.stop))

    def extend_3prime(self, by: Column) -> "Span":
        return self._with(F.when(self.reverse, self.start - by).otherwise(self.start),
                          F.when(self.reverse, self.stop).otherwise(self.stop + by))

    def clip_5prime(self, by: Column) -> "Span":
        return self._clippable(by).extend_5prime(-by)

    def clip_3prime(self, by: Column) -> "Span":
        return self._clippable(by).extend_3prime(-by)

    def _clippable(self, by: Column) -> "Span":
        checked = F.when(by < self.length(), self.start).otherwise(
            F.raise_error(F.lit("cannot clip the whole coordinate")))
        return self._with(checked)

    def to_zero_based(self) -> "Span":
        return self._with(self.start - 1, one_based=False)

    def to_one_based(self) -> "Span":
        checked = F.when(self.start < self.stop, self.start + 1).otherwise(
            F.raise_error(F.lit("a position between two bases has no 1-based form")))
        return self._with(checked, one_based=True)

    # -- relations -------------------------------------------------------------------------

    def _same_place(self, other: "Span", ignore_strand: bool) -> Column:
        if self.one_based != other.one_based:
            raise TypeError("coordinates of different kinds cannot be compared")
        same = self.chrom == other.chrom
        return same if ignore_strand else same & (self.reverse == other.reverse)

    def overlaps(self, other: "Span", ignore_strand: bool = False) -> Column:
        place = self._same_place(other, ignore_strand)
        if self.one_based:
            return place & (self.start <= other.stop) & (other.start <= self.stop)
        return place & (self.start < other.stop) & (other.start < self.stop)

    def intersection(self, other: "Span", ignore_strand: bool = False) -> Column:
        """Packed span on this span's strand, NULL without overlap."""
        common = self._with(F.greatest(self.start, other.start), F.least(self.stop, other.stop))
        return F.when(self.overlaps(other, ignore_strand), common.pack())

    def difference(self, other: "Span", ignore_strand: bool = False) -> Column:
        """Array of the zero to two packed spans left after removing ``other``."""
        step = 1 if self.one_based else 0
        hit = self.overlaps(other, ignore_strand)
        left = F.when(hit & (other.start > self.start), self._with(stop=other.start - step).pack())
        right = F.when(hit & (other.stop < self.stop), self._with(start=other.stop + step).pack())
        return F.array_compact(F.array(F.when(~hit, self.pack()), left, right))

    def is_5prime_of(self, other: "Span") -> Column:
        mine, theirs = self.boundary_3prime(), other.boundary_5prime()
        return self._beyond(other, forward=(mine, theirs), backward=(theirs, mine))

    def is_3prime_of(self, other: "Span") -> Column:
        mine, theirs = self.boundary_5prime(), other.boundary_3prime()
        return self._beyond(other, forward=(theirs, mine), backward=(mine, theirs))

    def _beyond(self, other: "Span", forward, backward) -> Column:
        def before(pair):
            return pair[0] < pair[1] if self.one_based else pair[0] <= pair[1]

        return self._same_place(other, False) & F.when(self.reverse, before(backward)).otherwise(before(forward))


def on_target(motif_location: Column, on_target_location: Column, share: float = 0.9) -> Column:
    """Whether the motif covers more than ``share`` of the on-target location, on either strand."""
    target = Span.parse(on_target_location)
    common = Span.parse(motif_location).intersection(target, ignore_strand=True)
    length = common["stop"] - common["start"] + 1
    return F.coalesce(length / target.length() > share, F.lit(False))


def cut_sites(text: Column) -> Column:
    """Sorted distinct unstranded locations of a ';'-separated list."""
    parts = F.filter(F.split(text, ";"), lambda p: p != "")
    return F.array_sort(F.array_distinct(F.transform(parts, lambda p: F.substring_index(p, ",", 1))))


def combine(df, keys: list[str], name: str = "span"):
    """Bounding range of packed spans per group; forward unless all members are reverse."""
    part = lambda field: F.col(f"{name}.{field}")
    grouped = df.groupBy(*keys).agg(
        F.min(part("chrom")).alias("_c"), F.max(part("chrom")).alias("_c2"),
        F.min(part("start")).alias("_s"), F.max(part("stop")).alias("_e"),
        F.every(part("is_reverse_strand")).alias("_r"), F.count(F.lit(1)).alias("_n"),
    )
    chrom = (
        F.when(F.col("_n") < 2, F.raise_error(F.lit("at least two coordinates are needed")))
        .when(F.col("_c") != F.col("_c2"), F.raise_error(F.lit("coordinates on different chromosomes")))
        .otherwise(F.col("_c"))
    )
    packed = Span(chrom, F.col("_s"), F.col("_e"), F.col("_r")).pack()
    return grouped.select(*keys, packed.alias(name))
