"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from blotter.llm import (exact_dedup, hard_negatives, host_rules, html_extract, jaccard_join, language_id, license_scan,
                         line_templates, mixing,
                         piece_sampling, quality_svm, token_alignment, url_filter)

MODULES = {
    "op1_exact_dedup": exact_dedup,
    "op2_quality_svm": quality_svm,
    "op3_language_id": language_id,
    "op4_line_templates": line_templates,
    "op5_piece_sampling": piece_sampling,
    "op6_url_filter": url_filter,
    "op7_host_rules": host_rules,
    "op8_mix_sources": mixing,
    "op9_jaccard_join": jaccard_join,
    "op10_html_extract": html_extract,
    "op11_hard_negatives": hard_negatives,
    "op12_license_scan": license_scan,
    "op13_token_alignment": token_alignment,
}


def queries() -> dict:
    return {name: getattr(module, name) for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: module.SQL for name, module in MODULES.items() if getattr(module, "SQL", None)}
