"""Queries of this subpackage, by name, and their DuckDB equivalents where SQL can state them."""

from __future__ import annotations

from citeloom.llm import decontaminate, langid, packing, privacy, quality, simhash, substring_dedup, token_files, topk, toxicity

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_simhash_near_dedup": simhash.op2_simhash_near_dedup,
    "op3_packing": packing.op3_packing,
    "op4_language_id": langid.op4_language_id,
    "op5_pii_surrogates": privacy.op5_pii_surrogates,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_quality": quality.op7_quality,
    "op8_benchmark_decontamination": decontaminate.op8_benchmark_decontamination,
    "op9_token_files": token_files.op9_token_files,
    "op10_exact_top_k": topk.op10_exact_top_k,
}

ORACLES: dict[str, str] = {
    "op10_exact_top_k": topk.OP10_SQL,
}
