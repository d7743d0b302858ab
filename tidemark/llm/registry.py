"""The queries of the training-data operators, with oracle SQL where SQL can express them."""

from __future__ import annotations

from tidemark.llm import decontaminate, html_extract, jaccard_join, licenses, line_dedup, lm_scoring, mixing, quality_rules, toxicity, url_filters


def queries() -> dict:
    return {
        "op1_quality_rules": quality_rules.op1_quality_rules,
        "op2_jaccard_join": jaccard_join.op2_jaccard_join,
        "op3_url_filters": url_filters.op3_url_filters,
        "op4_line_dedup": line_dedup.op4_line_dedup,
        "op5_license_scan": licenses.op5_license_scan,
        "op6_mixing": mixing.op6_mixing,
        "op7_lm_scoring": lm_scoring.op7_lm_scoring,
        "op8_decontamination": decontaminate.op8_decontamination,
        "op9_html_extract": html_extract.op9_html_extract,
        "op10_toxicity": toxicity.op10_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_url_filters": url_filters.ORACLE_SQL, "op8_decontamination": decontaminate.ORACLE_SQL}
