"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from geoweather.llm import ann, bpe, langid, lexsearch, lm, mixing, neardup, pii, prefixtrie, quality, toxicity, urlfilter, warc

QUERIES = {
    "op1_pii": pii.query,
    "op2_byte_bpe": bpe.query,
    "op3_lm_scores": lm.query,
    "op4_warc": warc.query,
    "op5_url_filter": urlfilter.query,
    "op6_mix_sources": mixing.query,
    "op7_quality_rules": quality.query,
    "op8_near_duplicates": neardup.query,
    "op9_nearest_neighbours": ann.query,
    "op10_language_id": langid.query,
    "op11_prefix_trie": prefixtrie.query,
    "op12_lexical_search": lexsearch.query,
    "op13_toxicity": toxicity.query,
}

ORACLE_SQL = {
    "op5_url_filter": urlfilter.ORACLE_SQL,
    "op6_mix_sources": mixing.ORACLE_SQL,
    "op11_prefix_trie": prefixtrie.ORACLE_SQL,
    "op12_lexical_search": lexsearch.ORACLE_SQL,
}
