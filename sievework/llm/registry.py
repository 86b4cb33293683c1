"""Queries of this subpackage, by name, with their SQL where there is one."""

from __future__ import annotations

from sievework.llm import licenses, mixing, ngram_join, oracles, packing, pii, quality, substrings, topk, toxicity, urls

QUERIES: dict = {
    "op1_licenses": licenses.op1_licenses,
    "op2_packing": packing.op2_packing,
    "op3_url_filter": urls.op3_url_filter,
    "op4_mixture": mixing.op4_mixture,
    "op5_quality": quality.op5_quality,
    "op6_topk": topk.op6_topk,
    "op7_repeated_passages": substrings.op7_repeated_passages,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_near_duplicates": ngram_join.op9_near_duplicates,
    "op10_pii": pii.op10_pii,
}
ORACLES: dict[str, str] = {
    "op4_mixture": oracles.MIXTURE,
    "op5_quality": oracles.QUALITY,
    "op6_topk": oracles.TOPK,
    "op7_repeated_passages": oracles.SUBSTRINGS,
    "op9_near_duplicates": oracles.NGRAM_JOIN,
}
