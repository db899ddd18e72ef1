"""Registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from ledgerlake.llm import op1_fingerprint, op2_ngram_join, op10_quality, op11_fill_middle, op12_packing, op13_prefix_trie, op3_url_filter, op4_mixing, op5_decontaminate, op6_license_scan, op7_html, op8_sharding, op9_suffix_dedup

QUERIES = {
    "op1_spot_signatures": op1_fingerprint.op1_spot_signatures,
    "op2_ngram_jaccard": op2_ngram_join.op2_ngram_jaccard,
    "op3_redirect_equivalence": op3_url_filter.op3_redirect_equivalence,
    "op4_apportioned_mix": op4_mixing.op4_apportioned_mix,
    "op5_seed_and_align": op5_decontaminate.op5_seed_and_align,
    "op6_diagonal_voting": op6_license_scan.op6_diagonal_voting,
    "op7_wrapper_induction": op7_html.op7_wrapper_induction,
    "op8_jump_sharding": op8_sharding.op8_jump_sharding,
    "op9_suffix_runs": op9_suffix_dedup.op9_suffix_runs,
    "op10_importance_resampling": op10_quality.op10_importance_resampling,
    "op11_exception_index": op11_fill_middle.op11_exception_index,
    "op12_best_fit_packing": op12_packing.op12_best_fit_packing,
    "op13_rollup_trie": op13_prefix_trie.op13_rollup_trie,
}

ORACLES = {
    "op1_spot_signatures": op1_fingerprint.ORACLE,
    "op3_redirect_equivalence": op3_url_filter.ORACLE,
    "op4_apportioned_mix": op4_mixing.ORACLE,
    "op6_diagonal_voting": op6_license_scan.ORACLE,
    "op8_jump_sharding": op8_sharding.ORACLE,
    "op11_exception_index": op11_fill_middle.ORACLE,
    "op13_rollup_trie": op13_prefix_trie.ORACLE,
}
