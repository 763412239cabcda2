"""Best match of the on-target motif near a site.

The windows around sites are cut out of a chunked genome table with an equi-join; the alignment is
a vectorised pandas UDF that fills the score table of a whole Arrow batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuswave.functions.dna import IUPAC, base_mask, reverse_complement_text
from locuswave.params import Params

MATCH_TYPE = "struct<sequence:string,begin:int,finish:int,score:int,subs:int,gaps:int,is_reverse:boolean>"
_MASKS = np.array([base_mask(chr(i)) if chr(i).isalpha() else 0 for i in range(256)], dtype=np.uint8)
DIAGONAL, ACROSS, DOWN = 0, 1, 2


def site_windows(sites: DataFrame, genome: DataFrame, half_width: int | Column, chunk: int,
                 keys: tuple[str, ...] = ("chrom", "pos")) -> DataFrame:
    """Add ``window`` (bases of ``[pos - w, pos + w)``, cut at contig ends) and ``window_start``.

    ``half_width`` may differ from site to site.  ``genome`` has rows ``(chrom, chunk_id, seq)``, every
    chunk but a contig's last ``chunk`` bases long.  A window meets a fixed number of chunks, so the
    pieces per site are few.
    """
    width = half_width if isinstance(half_width, Column) else F.lit(half_width)
    sites = sites.withColumn("_half", F.coalesce(width, F.lit(0)).cast("long"))
    keys = (*keys, "_half")
    start = F.greatest(F.col("pos") - F.col("_half"), F.lit(0))
    spots = (sites.select(*keys).filter("_half > 0").distinct()
             .withColumn("_from", start).withColumn("_to", F.col("pos") + F.col("_half")))
    cells = F.sequence(F.expr(f"_from div {chunk}"), F.expr(f"(_to - 1) div {chunk}"))
    offset = F.greatest(F.col("_from") - F.col("chunk_id") * chunk, F.lit(0))
    length = F.col("_to") - F.col("chunk_id") * chunk - offset
    pieces = (
        spots.withColumn("chunk_id", F.explode(cells)).join(genome, ["chrom", "chunk_id"])
        .withColumn("_piece", F.substring(F.col("seq"), (offset + 1).cast("int"), length.cast("int")))
    )
    window = F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("chunk_id", "_piece"))), lambda p: p["_piece"]), "")
    windows = pieces.groupBy(*keys).agg(window.alias("window"))
    return (
        sites.join(windows, list(keys), "left")
        .withColumn("window_start", start).withColumn("window", F.coalesce("window", F.lit(""))).drop("_half")
    )


def find_motif(sites: DataFrame, params: Params, motif: str = "on_target_motif") -> DataFrame:
    """Add ``closest_motif``, ``motif_location`` (1-based), ``motif_score``, ``num_subs``, ``num_gaps``.

    The motif is aligned whole, the window may overhang for free; the forward strand wins ties.
    """
    aligned = sites.withColumn("_m", motif_udf(params)(F.col(motif), F.col("window")))
    begin, finish = F.col("window_start") + F.col("_m.begin"), F.col("window_start") + F.col("_m.finish")
    location = F.concat(
        F.col("chrom"), F.lit(":"), (begin + 1).cast("string"), F.lit("-"), finish.cast("string"),
        F.when(F.col("_m.is_reverse"), F.lit(",-")).otherwise(F.lit(",+")))
    return aligned.select(
        *sites.columns,
        F.col("_m.sequence").alias("closest_motif"), location.alias("motif_location"),
        F.col("_m.score").alias("motif_score"), F.col("_m.subs").alias("num_subs"),
        F.col("_m.gaps").alias("num_gaps"),
    )


def motif_udf(params: Params):
    match, mismatch, gap = params.motif_match_score, params.motif_mismatch_pen, params.motif_gap_pen

    @F.pandas_udf(MATCH_TYPE)
    def best_match(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for motifs, windows in batches:
            yield align_batch(motifs, windows, match, mismatch, gap)

    return best_match


def align_batch(motifs: pd.Series, windows: pd.Series, match: int, mismatch: int, gap: int) -> pd.DataFrame:
    columns = ["sequence", "begin", "finish", "score", "subs", "gaps", "is_reverse"]
    result = pd.DataFrame(index=range(len(motifs)), columns=columns, dtype=object)
    motifs, windows = motifs.reset_index(drop=True), windows.reset_index(drop=True)
    # Few distinct motifs (one per sample group), many windows: one table per motif and length.
    usable = motifs.notna() & windows.notna() & (windows.str.len() > 0)
    for motif, rows in windows[usable].groupby(motifs[usable]):
        for _, same_length in rows.groupby(rows.str.len()):
            result.loc[same_length.index] = _both_strands(motif, list(same_length), match, mismatch, gap)
    for name in ("begin", "finish", "score", "subs", "gaps"):
        result[name] = result[name].astype("Int32")
    return result


def _both_strands(motif: str, windows: list[str], match: int, mismatch: int, gap: int) -> list[tuple]:
    forward = _align(motif.upper(), windows, match, mismatch, gap)
    backward = _align(reverse_complement_text(motif.upper()), windows, match, mismatch, gap)
    return [
        (*f, False) if f[3] >= b[3] else (reverse_complement_text(b[0]), *b[1:], True)
        for f, b in zip(forward, backward)
    ]


def _align(motif: str, windows: list[str], match: int, mismatch: int, gap: int) -> list[tuple]:
    """Score table row by row over all windows; a gap of length k costs k * gap."""
    letters = np.frombuffer("".join(windows).upper().encode(), dtype=np.uint8).reshape(len(windows), -1)
    query = np.frombuffer(motif.encode(), dtype=np.uint8)
    width = letters.shape[1]
    slope = gap * np.arange(width + 1)
    table = np.zeros((len(query) + 1, len(windows), width + 1), dtype=np.int32)
    hits = [(_MASKS[letters] & _MASKS[code]) > 0 for code in query]
    for i, hit in enumerate(hits, 1):
        best = table[i - 1] - gap
        best[:, 1:] = np.maximum(best[:, 1:], table[i - 1][:, :-1] + np.where(hit, match, -mismatch))
        # Gaps along the window: a running maximum after removing the linear gap cost.
        table[i] = np.maximum.accumulate(best + slope, axis=1) - slope
    return [
        _trace(motif, window, table[:, row], [h[row] for h in hits], match, mismatch, gap)
        for row, window in enumerate(windows)
    ]


def _trace(motif: str, window: str, table: np.ndarray, hits: list[np.ndarray],
           match: int, mismatch: int, gap: int) -> tuple:
    """Walk back from the leftmost best end, preferring the diagonal; report the covered bases.

    A degenerate window base scores as a match but is shown and counted as a substitution, unless
    the motif has the same code there.
    """
    finish = int(table[len(motif)].argmax())
    i, j, subs, gaps, shown = len(motif), finish, 0, 0, []
    in_motif_gap = False
    while i > 0:
        step = None
        if j > 0 and table[i, j] == table[i - 1, j - 1] + (match if hits[i - 1][j - 1] else -mismatch):
            step = DIAGONAL
        elif table[i, j] == table[i - 1, j] - gap:
            step = DOWN
        else:
            step = ACROSS
        if step == DIAGONAL:
            i, j = i - 1, j - 1
            base = window[j].upper()
            same = base == motif[i] or base in IUPAC[motif[i]]
            subs += not same
            shown.append(base if same else base.lower())
        elif step == DOWN:
            i, gaps = i - 1, gaps + 1
            if not in_motif_gap:
                shown.append("-")
        else:
            j, gaps = j - 1, gaps + 1
            shown.append(window[j].lower())
        in_motif_gap = step == DOWN
    return "".join(reversed(shown)), j, finish, int(table[len(motif)][finish]), subs, gaps
