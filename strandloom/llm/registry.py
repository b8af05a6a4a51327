"""Queries of this subpackage and their DuckDB SQL, by name."""

from __future__ import annotations

from . import decontaminate, html_text, licenses, merkle, mixing, near_dup, prefix_trie, quality, records, secrets, tokens, url_rules, vector_forest

_QUERIES = {
    "op1_secrets": secrets,
    "op2_token_counts": tokens,
    "op3_benchmark_leaks": decontaminate,
    "op4_token_records": records,
    "op5_mix_sources": mixing,
    "op6_quality_rules": quality,
    "op7_near_duplicates": near_dup,
    "op8_licenses": licenses,
    "op9_url_rules": url_rules,
    "op10_html_text": html_text,
    "op11_near_vectors": vector_forest,
    "op12_conversation_trie": prefix_trie,
    "op13_manifest_proofs": merkle,
}


def queries():
    return {name: module.query for name, module in _QUERIES.items()}


def oracle_sql():
    return {name: module.ORACLE_SQL for name, module in _QUERIES.items() if getattr(module, "ORACLE_SQL", None)}
