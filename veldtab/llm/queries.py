"""Registered queries of the text operators, and their SQL where SQL can express them."""

from __future__ import annotations

from veldtab.llm import (context_tree, decontaminate, language, licenses, merge_count, mixing, order_minhash, periodic_runs, quality, secrets, simhash,
                         toxicity, whitening)

QUERIES = {
    "op1_context_tree_scores": context_tree.op1_context_tree_scores,
    "op2_raked_mix": mixing.op2_raked_mix,
    "op3_merge_token_counts": merge_count.op3_merge_token_counts,
    "op4_secret_spans": secrets.op4_secret_spans,
    "op5_benchmark_windows": decontaminate.op5_benchmark_windows,
    "op6_simhash_components": simhash.op6_simhash_components,
    "op7_language": language.op7_language,
    "op8_weak_label_quality": quality.op8_weak_label_quality,
    "op9_licence_scan": licenses.op9_licence_scan,
    "op10_order_minhash": order_minhash.op10_order_minhash,
    "op11_whitened_embeddings": whitening.op11_whitened_embeddings,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_toxicity": toxicity.op13_toxicity,
}
ORACLES = {
    "op2_raked_mix": mixing.OP2_SQL,
    "op5_benchmark_windows": decontaminate.OP5_SQL,
}
