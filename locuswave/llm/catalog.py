"""Queries of the text operators and their SQL twins, where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from locuswave.llm import (
    decontaminate, langid, licenses, mixing, near_dedup, packing, pii, preference, quality, repair, token_files, toxicity,
    whitening,
)

LLM_QUERIES = {
    "op1_preference_pairs": preference.op1_preference_pairs,
    "op2_template_leaks": decontaminate.op2_template_leaks,
    "op3_toxicity_ftrl": toxicity.op3_toxicity_ftrl,
    "op4_near_duplicates": near_dedup.op4_near_duplicates,
    "op5_best_fit_packing": packing.op5_best_fit_packing,
    "op6_mixed_range_files": token_files.op6_mixed_range_files,
    "op10_bilstm_crf_pii": pii.op10_bilstm_crf_pii,
    "op7_license_scan": licenses.op7_license_scan,
    "op8_string_kernel_language": langid.op8_string_kernel_language,
    "op9_quality_ledger": quality.op9_quality_ledger,
    "op11_prefix_cut_mixing": mixing.op11_prefix_cut_mixing,
    "op12_feast_whitening": whitening.op12_feast_whitening,
    "op13_grammar_alignment_repair": repair.op13_grammar_alignment_repair,
    "pipeline": corpus_pipeline.run,
}

LLM_ORACLES = {
    "op1_preference_pairs": preference.OP1_SQL,
    "op2_template_leaks": decontaminate.OP2_SQL,
    "op7_license_scan": licenses.OP7_SQL,
    "op9_quality_ledger": quality.OP9_SQL,
    "op11_prefix_cut_mixing": mixing.OP11_SQL,
    "op13_grammar_alignment_repair": repair.OP13_SQL,
}

if corpus_pipeline.ORACLE_SQL:
    LLM_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
