"""Queries and SQL of this subpackage, for ``__spark_entry__.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gazette.llm import fingerprint, html_extract, language, license_scan, mixing, neardup, packing, pii, quality, resampling, topk, toxicity, whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        topk.op1_exact_top_k, html_extract.op2_html_extraction, license_scan.op3_license_scan, packing.op4_packing, mixing.op5_source_mixing,
        neardup.op6_minhash_neardup, toxicity.op7_toxicity, language.op8_language_id, quality.op9_quality, fingerprint.op10_fingerprint,
        whitening.op11_embedding_whitening, resampling.op12_importance_resampling, pii.op13_pii,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_top_k": topk.ORACLE_SQL}
