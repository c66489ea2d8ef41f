"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from tallyhouse.llm import (
    cost_packing, decontamination, embedding_dedup, filter_audit, language_id, lexical_search, license_scans, packing, secret_scans, simhash,
    token_counts, toxicity, warc,
)

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_token_counts": token_counts.op2_token_counts,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_secret_scans": secret_scans.op4_secret_scans,
    "op5_embedding_near_dedup": embedding_dedup.op5_embedding_near_dedup,
    "op6_license_scans": license_scans.op6_license_scans,
    "op7_benchmark_decontamination": decontamination.op7_benchmark_decontamination,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_simhash_near_dedup": simhash.op9_simhash_near_dedup,
    "op10_warc": warc.op10_warc,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_ranked_lexical_search": lexical_search.op12_ranked_lexical_search,
    "op13_cost_balanced_packing": cost_packing.op13_cost_balanced_packing,
}

ORACLE = {
    "op4_secret_scans": secret_scans.ORACLE,
    "op6_license_scans": license_scans.ORACLE,
    "op7_benchmark_decontamination": decontamination.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
    "op12_ranked_lexical_search": lexical_search.ORACLE,
}
