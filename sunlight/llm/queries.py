"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from . import (embedding_dedup, exact_dedup, fill_in_middle, language_id, lexical_search, line_dedup, mixing, packing,
               pii, secret_scan, sharding, simhash, url_filter)

QUERIES = {
    "op1_secret_scan": secret_scan.op1_secret_scan,
    "op2_soft_mixing": mixing.op2_soft_mixing,
    "op3_bootstrapped_pii": pii.op3_bootstrapped_pii,
    "op4_best_fit_packing": packing.op4_best_fit_packing,
    "op5_simhash_near_dedup": simhash.op5_simhash_near_dedup,
    "op6_sampled_splitters": sharding.op6_sampled_splitters,
    "op7_embedding_pq": embedding_dedup.op7_embedding_pq,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_language_id": language_id.op9_language_id,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_fill_in_middle": fill_in_middle.op11_fill_in_middle,
    "op12_lexical_search": lexical_search.op12_lexical_search,
    "op13_url_filter": url_filter.op13_url_filter,
}

# The other operators are tested against brute-force versions in tests/llm.
ORACLE = {
    "op8_line_dedup": line_dedup.OP8_SQL,
    "op10_exact_dedup": exact_dedup.OP10_SQL,
    "op11_fill_in_middle": fill_in_middle.OP11_SQL,
    "op12_lexical_search": lexical_search.OP12_SQL,
    "op13_url_filter": url_filter.OP13_SQL,
}
