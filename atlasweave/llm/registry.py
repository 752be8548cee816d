"""Queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from atlasweave.llm import audit, chat, decontaminate, langid, licenses, packing, pii, pitman, simhash, tokens, topk, toxicity, variants

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_topk": topk.op1_exact_topk,
    "op2_packing": packing.op2_packing,
    "op3_decontamination": decontaminate.op3_decontamination,
    "op4_simhash": simhash.op4_simhash,
    "op5_license_scan": licenses.op5_license_scan,
    "op6_pii": pii.op6_pii,
    "op7_chat": chat.op7_chat,
    "op8_token_counts": tokens.op8_token_counts,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_language_id": langid.op10_language_id,
    "op11_filter_audit": audit.op11_filter_audit,
    "op12_spelling_variants": variants.op12_spelling_variants,
    "op13_lm_scores": pitman.op13_lm_scores,
}
ORACLE_SQL: dict[str, str] = {"op1_exact_topk": topk.ORACLE, "op11_filter_audit": audit.ORACLE}
