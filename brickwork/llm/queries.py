"""The registered queries of this folder, and their SQL where SQL can express them."""

from __future__ import annotations

from brickwork.llm import fingerprint, minhash, mixing, packing, pages, quality, scoring, secrets, substrings, topk

QUERIES = {
    "op1_substring_dedup": substrings.query,
    "op2_exact_topk": topk.query,
    "op3_best_fit_packing": packing.query,
    "op4_lm_scoring": scoring.query,
    "op5_document_fingerprints": fingerprint.query,
    "op6_html_extraction": pages.query,
    "op7_secret_scans": secrets.query,
    "op8_minhash_near_dedup": minhash.query,
    "op9_quality_classifier": quality.query,
    "op10_source_mixing": mixing.query,
}
ORACLES: dict[str, str] = {"op2_exact_topk": topk.ORACLE}
