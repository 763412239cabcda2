"""Analysis parameters and their defaults."""

from __future__ import annotations

from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Params:
    # The defaults a user of the assay expects.
    apply_normalization: bool = True
    use_umis: bool = True
    umi_length: int = 7
    umi_base_qual_thresh: int = 20
    max_lowq_umi_bases: int = 1
    stat_window: int = 5
    peak_window: int = 5
    agg_peak_window: int = 10
    control_noise_window: int = 150
    test_pval_calling_thresh: float = 1e-5
    test_pval_reporting_thresh: float = 1e-3
    ctrl_noise_pval_calling_thresh: float = 5e-3
    include_noise_pval_fails: bool = False
    min_aln_length: int = 20
    max_clipping: int = 0
    min_map_qual: int = 5
    motif_search_factor: float = 1.0
    motif_match_score: int = 1
    motif_mismatch_pen: int = 1
    motif_gap_pen: int = 8
    subsample_fastqs: bool = False
    subsample_target_reads: int | None = None
    subsample_seed: int = 100
    trim_adapters: bool = True
    min_peak_signal: float = 1.0
    on_target_overlap: float = 0.9

    # Layout knobs (no influence on results).
    tile: int = 8_192
    lookup_bucket: int = 256

    # Compatibility switches, see README.
    compat_background_threshold: bool = False
    compat_wide_totals: bool = False
    compat_histogram_overwrite: bool = False

    def __post_init__(self) -> None:
        if self.umi_length <= 0 or self.umi_base_qual_thresh <= 0 or self.max_lowq_umi_bases < 0:
            raise ValueError("UMI length and quality must be positive, allowed low bases >= 0")
        for name in ("stat_window", "peak_window", "agg_peak_window", "control_noise_window",
                     "min_aln_length", "max_clipping", "min_map_qual"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must not be negative")
        for name in ("test_pval_calling_thresh", "test_pval_reporting_thresh",
                     "ctrl_noise_pval_calling_thresh"):
            if not 0 <= getattr(self, name) <= 1:
                raise ValueError(f"{name} must lie in [0, 1]")
        if self.subsample_fastqs and not self.subsample_target_reads:
            raise ValueError("subsample_fastqs needs subsample_target_reads")
        if self.tile < 2 * max(self.stat_window, self.control_noise_window) + 2:
            raise ValueError("tile must be wider than a window")

    @classmethod
    def from_dict(cls, values: dict) -> "Params":
        known = {f.name for f in fields(cls)}
        unknown = set(values) - known
        if unknown:
            raise ValueError(f"unknown parameters: {sorted(unknown)}")
        return cls(**values)
