"""Registered queries of the operators in this folder, and their DuckDB twins."""

from __future__ import annotations

from barcodeforge.llm import (
    basic_factors,
    block_labeller,
    dictionary_quality,
    histogram_packing,
    line_cleaning,
    lyndon_suffixes,
    partial_matching,
    perspectives,
    signed_fingerprints,
    simhash_hamming,
    string_tiling,
    token_alignment,
    warc_store,
)

QUERIES = {
    "op1_dictionary_quality": dictionary_quality.op1,
    "op2_string_tiling": string_tiling.op2,
    "op3_warc_store": warc_store.op3,
    "op4_partial_matching": partial_matching.op4,
    "op5_block_labeller": block_labeller.op5,
    "op6_lyndon_suffixes": lyndon_suffixes.op6,
    "op7_simhash_hamming": simhash_hamming.op7,
    "op8_perspectives": perspectives.op8,
    "op9_signed_fingerprints": signed_fingerprints.op9,
    "op10_histogram_packing": histogram_packing.op10,
    "op11_basic_factors": basic_factors.op11,
    "op12_line_cleaning": line_cleaning.op12,
    "op13_token_alignment": token_alignment.op13,
}

ORACLES: dict[str, str] = {
    "op3_warc_store": warc_store.ORACLE,
    "op6_lyndon_suffixes": lyndon_suffixes.ORACLE,
    "op8_perspectives": perspectives.ORACLE,
    "op11_basic_factors": basic_factors.ORACLE,
    "op12_line_cleaning": line_cleaning.ORACLE,
}
