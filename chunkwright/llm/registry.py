"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from . import collocations, fingerprints, license_scan, line_dedup, line_quality, mixing, ngram_join, packing, pii, quality, suffix_dedup, token_align, topk

QUERIES = {
    "op1_fingerprints": fingerprints.op1,
    "op2_license_scan": license_scan.op2,
    "op3_suffix_dedup": suffix_dedup.op3,
    "op4_ngram_join": ngram_join.op4,
    "op5_packing": packing.op5,
    "op6_mixing": mixing.op6,
    "op7_line_dedup": line_dedup.op7,
    "op8_exact_topk": topk.op8,
    "op9_pii_surrogates": pii.op9,
    "op10_quality": quality.op10,
    "op11_collocations": collocations.op11,
    "op12_token_align": token_align.op12,
    "op13_line_quality": line_quality.op13,
}

ORACLE_SQL = {
    "op2_license_scan": license_scan.OP2_SQL,
    "op4_ngram_join": ngram_join.OP4_SQL,
    "op6_mixing": mixing.OP6_SQL,
    "op7_line_dedup": line_dedup.OP7_SQL,
    "op8_exact_topk": topk.OP8_SQL,
    "op11_collocations": collocations.OP11_SQL,
    "op13_line_quality": line_quality.OP13_SQL,
}
