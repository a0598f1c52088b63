"""The queries of this package and, where SQL can express one, its DuckDB twin."""

from __future__ import annotations

from tidewright.llm import language_id, mixing, packing, pii, quality_classifier, quality_rules, sentence_pieces, simhash, token_alignment, toxicity, url_filter, vector_codes, vector_search

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_mixing": mixing.op3_mixing,
    "op4_quality_fm": quality_classifier.op4_quality_fm,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_simhash": simhash.op6_simhash,
    "op7_url_filter": url_filter.op7_url_filter,
    "op8_packing": packing.op8_packing,
    "op9_language": language_id.op9_language,
    "op10_vector_topk": vector_search.op10_vector_topk,
    "op11_sentencepiece": sentence_pieces.op11_sentencepiece,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_token_alignment": token_alignment.op13_token_alignment,
}

ORACLE_SQL = {
    "op2_quality_rules": quality_rules.ORACLE,
    "op3_mixing": mixing.ORACLE,
    "op7_url_filter": url_filter.ORACLE,
    "op10_vector_topk": vector_search.ORACLE,
    "op12_vector_codes": vector_codes.ORACLE,
}
