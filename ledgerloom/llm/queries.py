"""The queries of the training-data operators, and SQL where SQL can express them."""

from __future__ import annotations

from . import decontaminate, jaccard, langid, lexical, lines, manifest, packing, passages, quality, topk, toxicity, warc, windows

QUERIES = {
    "op1_decontamination": decontaminate.op1_decontamination,
    "op2_line_dedup": lines.op2_line_dedup,
    "op3_language_id": langid.op3_language_id,
    "op4_quality_classifier": quality.op4_quality_classifier,
    "op5_ngram_jaccard_join": jaccard.op5_ngram_jaccard_join,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_warc": warc.op7_warc,
    "op9_exact_topk": topk.op9_exact_topk,
    "op10_substring_dedup": passages.op10_substring_dedup,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op11_ranked_search": lexical.op11_ranked_search,
    "op12_sum_of_squares_packing": windows.op12_sum_of_squares_packing,
    "op13_merkle_manifest": manifest.op13_merkle_manifest,
}
ORACLES = {
    "op5_ngram_jaccard_join": jaccard.OP5_SQL, "op7_warc": warc.OP7_SQL, "op9_exact_topk": topk.OP9_SQL, "op10_substring_dedup": passages.OP10_SQL, "op11_ranked_search": lexical.OP11_SQL,
    "op13_merkle_manifest": manifest.OP13_SQL,
}
