"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import (
    bpe,
    conversation_repair,
    decontaminate,
    fingerprints,
    preference,
    prefix_trie,
    quality,
    sharding,
    simhash,
    token_counts,
    token_files,
    toxicity,
    url_filter,
)

QUERIES = {
    "op1_bpe": bpe.op1_bpe,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_simhash_near_dedup": simhash.op3_simhash_near_dedup,
    "op4_token_files": token_files.op4_token_files,
    "op5_decontamination": decontaminate.op5_decontamination,
    "op6_sharding": sharding.op6_sharding,
    "op7_preference_pairs": preference.op7_preference_pairs,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_url_filter": url_filter.op9_url_filter,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_fingerprints": fingerprints.op11_fingerprints,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}
ORACLES = {
    "op6_sharding": sharding.ORACLE,
    "op7_preference_pairs": preference.ORACLE,
    "op9_url_filter": url_filter.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
