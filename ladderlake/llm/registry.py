"""The registered queries of the subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from ladderlake.llm import (
    bpe,
    chat_format,
    decontaminate,
    exact_dedup,
    hard_negatives,
    html_crf,
    license_scan,
    quality_gam,
    simhash,
    suffix_dedup,
    super_kmers,
    toxicity_fm,
    turn_repair,
)

QUERIES = {
    "op1_simhash_near_dedup": simhash.query,
    "op2_html_extraction": html_crf.query,
    "op3_bpe": bpe.query,
    "op4_exact_dedup": exact_dedup.query,
    "op5_toxicity": toxicity_fm.query,
    "op6_decontamination": decontaminate.query,
    "op7_chat_format": chat_format.query,
    "op8_license_scan": license_scan.query,
    "op9_quality": quality_gam.query,
    "op10_suffix_dedup": suffix_dedup.query,
    "op11_hard_negatives": hard_negatives.query,
    "op12_super_kmers": super_kmers.query,
    "op13_turn_repair": turn_repair.query,
}

ORACLES = {
    "op4_exact_dedup": exact_dedup.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
}
