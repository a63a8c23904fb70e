"""Queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from activlake.llm import (
    chat,
    decontamination,
    html_text,
    lm_scoring,
    packing,
    pii,
    prefix_trie,
    quality,
    simhash,
    substrings,
    token_counts,
    toxicity,
    whitening,
)

QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op10_personal_data": pii.op10_personal_data,
    "op11_embedding_whitening": whitening.op11_embedding_whitening,
    "op12_substring_dedup": substrings.op12_substring_dedup,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
    "op2_decontamination": decontamination.op2_decontamination,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_quality_rules": quality.op5_quality_rules,
    "op6_simhash_dedup": simhash.op6_simhash_dedup,
    "op7_lm_scoring": lm_scoring.op7_lm_scoring,
    "op8_html_text": html_text.op8_html_text,
    "op9_chat_format": chat.op9_chat_format,
}

ORACLE = {
    "op12_substring_dedup": substrings.OP12_SQL,
    "op13_prefix_trie": prefix_trie.OP13_SQL,
    "op2_decontamination": decontamination.OP2_SQL,
    "op5_quality_rules": quality.OP5_SQL,
    "op9_chat_format": chat.OP9_SQL,
}
