"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from kawara.llm import (
    exact_dedup,
    hard_negatives,
    language_id,
    license_scan,
    mixing,
    near_dedup,
    packing,
    prefix_trie,
    quality,
    sharding,
    substring_dedup,
    token_counts,
    topk_search,
)

REGISTRY = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_sharding": sharding.op3_sharding,
    "op4_topk_search": topk_search.op4_topk_search,
    "op5_near_dedup": near_dedup.op5_near_dedup,
    "op6_mixing": mixing.op6_mixing,
    "op7_quality": quality.op7_quality,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_substring_dedup": substring_dedup.op9_substring_dedup,
    "op10_packing": packing.op10_packing,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_language_id": language_id.op12_language_id,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

SQL = {
    "op2_exact_dedup": exact_dedup.SQL,
    "op4_topk_search": topk_search.SQL,
    "op11_prefix_trie": prefix_trie.SQL,
    "op12_language_id": language_id.op12_language_id,
    "op13_hard_negatives": hard_negatives.SQL,
}
