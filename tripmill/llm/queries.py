"""The queries of this folder and, where SQL can express them, their SQL."""

from __future__ import annotations

from tripmill.llm import decontamination, fingerprints, jaccard_join, language_model, line_dedup, packing, ranked_search, sharding, suffix_dedup, token_files, toxicity, warc, whitening

QUERIES = {
    "op1_fingerprints": fingerprints.op1_fingerprints,
    "op2_best_fit_packing": packing.op2_best_fit_packing,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_warc": warc.op4_warc,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_decontamination": decontamination.op6_decontamination,
    "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
    "op8_token_files": token_files.op8_token_files,
    "op9_jaccard_join": jaccard_join.op9_jaccard_join,
    "op10_sharding": sharding.op10_sharding,
    "op11_whitening": whitening.op11_whitening,
    "op12_lm_scoring": language_model.op12_lm_scoring,
    "op13_ranked_search": ranked_search.op13_ranked_search,
}

ORACLE_SQL = {
    "op3_line_dedup": line_dedup.ORACLE,
    "op4_warc": warc.ORACLE,
    "op6_decontamination": decontamination.ORACLE,
    "op9_jaccard_join": jaccard_join.ORACLE,
    "op13_ranked_search": ranked_search.ORACLE,
}
