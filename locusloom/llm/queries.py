"""The registered queries of the training-data operators and their DuckDB equivalents, where SQL can express them."""

from __future__ import annotations

from . import binary_packing, clustering, decontamination, exact_dedup, language_id, line_dedup, lm_scoring, near_dedup, packing, toxicity, url_filters, warc, whitening

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_best_fit_packing": packing.op2_best_fit_packing,
    "op3_language_id": language_id.op3_language_id,
    "op4_minhash_near_dedup": near_dedup.op4_minhash_near_dedup,
    "op5_lm_scoring": lm_scoring.op5_lm_scoring,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_benchmark_decontamination": decontamination.op7_benchmark_decontamination,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_warc": warc.op9_warc,
    "op10_url_filters": url_filters.op10_url_filters,
    "op11_yinyang_clustering": clustering.op11_yinyang_clustering,
    "op12_binary_packing": binary_packing.op12_binary_packing,
    "op13_embedding_whitening": whitening.op13_embedding_whitening,
}
ORACLES = {
    "op4_minhash_near_dedup": near_dedup.OP4_SQL,
    "op7_benchmark_decontamination": decontamination.OP7_SQL,
    "op8_exact_dedup": exact_dedup.OP8_SQL,
    "op9_warc": warc.OP9_SQL,
    "op10_url_filters": url_filters.OP10_SQL,
    "op11_yinyang_clustering": clustering.OP11_SQL,
}
