"""The registered queries of this subpackage and, where SQL can express them, their oracles."""

from __future__ import annotations

from . import bpe, decontaminate, hamming, language, lines, minhash, mixing, negatives, pii, quality, runs, suffixes, token_files

QUERIES = {
    "op1_line_dedup": lines.query,
    "op2_minhash_near_dedup": minhash.query,
    "op3_hamming_top_k": hamming.query,
    "op4_decontamination": decontaminate.query,
    "op5_quality_classifier": quality.query,
    "op6_suffix_dedup": suffixes.query,
    "op7_token_files": token_files.query,
    "op8_bpe": bpe.query,
    "op9_pii": pii.query,
    "op10_language_id": language.query,
    "op11_periodic_runs": runs.query,
    "op12_hard_negatives": negatives.query,
    "op13_source_mixing": mixing.query,
}

ORACLES = {
    "op1_line_dedup": lines.ORACLE,
    "op3_hamming_top_k": hamming.ORACLE,
    "op12_hard_negatives": negatives.ORACLE,
    "op13_source_mixing": mixing.ORACLE,
}
