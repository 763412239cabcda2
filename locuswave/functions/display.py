"""Text forms of values in reports, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letter colours of displayed sequences.
BASE_COLORS = {"A": "#008000", "C": "#0000FF", "G": "#FFC300", "T": "#FF0000"}
OTHER_COLOR = "#000000"


def escaped(text: Column) -> Column:
    """Text as it may stand in HTML, inside quoted attributes too."""
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def integer(x: Column) -> Column:
    return F.format_number(x, 0)


def decimal(x: Column) -> Column:
    return F.format_number(x, 2)


def p_value(x: Column) -> Column:
    return F.when(x.isNotNull(), F.format_string("%.3e", x))


def percentage(x: Column) -> Column:
    return F.when(x.isNotNull(), F.concat(F.format_string("%.2f", x), F.lit("%")))


def number_list(xs: Column) -> Column:
    return F.array_join(F.transform(xs, decimal), "; ")


def integer_list(xs: Column) -> Column:
    return F.array_join(F.transform(xs, integer), "; ")


def percentage_list(xs: Column) -> Column:
    return F.array_join(F.transform(xs, percentage), "; ")


def coordinate(text: Column) -> Column:
    """``chr1:1234-5678,+`` with thousands separators."""
    chrom = F.substring_index(text, ":", 1)
    place, strand = F.split(F.substring_index(text, ":", -1), ",")[0], F.substring_index(text, ",", -1)
    numbers = F.transform(F.split(place, "-"), lambda p: integer(p.cast("long")))
    return F.concat(chrom, F.lit(":"), F.array_join(numbers, "-"), F.lit(","), strand)


def dna_html(seq: Column) -> Column:
    """Sequence with one coloured span per letter."""
    def letter(c: Column) -> Column:
        color = F.lit(OTHER_COLOR)
        for base, shade in BASE_COLORS.items():
            color = F.when(F.upper(c) == base, F.lit(shade)).otherwise(color)
        return F.concat(F.lit('<span style="color:'), color, F.lit('">'), escaped(c), F.lit("</span>"))

    letters = F.filter(F.split(seq, ""), lambda c: c != "")
    return F.concat(F.lit("<span style='font-family:monospace'>"),
                    F.array_join(F.transform(letters, letter), ""), F.lit("</span>"))
