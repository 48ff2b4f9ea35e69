"""Registered queries of this subpackage and their SQL counterparts."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scorewatch.llm.common import ship_package
from scorewatch.llm import exact_top_k, lm_scores, merkle_manifest, source_divergence
from scorewatch.llm.byte_bpe import op11_byte_bpe
from scorewatch.llm.exact_top_k import op10_exact_top_k
from scorewatch.llm.language_id import op4_language_id
from scorewatch.llm.lm_scores import op6_lm_scoring
from scorewatch.llm.merkle_manifest import op12_merkle_manifest
from scorewatch.llm.mixing import op2_source_mixing
from scorewatch.llm.near_duplicates import op3_minhash_near_dedup
from scorewatch.llm.packing import op7_packing
from scorewatch.llm.personal_data import op9_pii
from scorewatch.llm.quality_classifier import op8_quality_classifier
from scorewatch.llm.quality_rules import op5_quality_rules
from scorewatch.llm.source_divergence import op13_source_divergence
from scorewatch.llm.url_filters import op1_url_filters

Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    """The query, after the package's code has been handed to the executors."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    return run


def queries() -> dict[str, Query]:
    return {query.__name__: _shipped(query) for query in (
        op1_url_filters, op2_source_mixing, op3_minhash_near_dedup, op4_language_id,
        op5_quality_rules, op6_lm_scoring, op7_packing, op8_quality_classifier, op9_pii,
        op10_exact_top_k, op11_byte_bpe, op12_merkle_manifest, op13_source_divergence,
    )}


def oracle_sql() -> dict[str, str]:
    return {"op6_lm_scoring": lm_scores.ORACLE, "op10_exact_top_k": exact_top_k.ORACLE,
            "op12_merkle_manifest": merkle_manifest.ORACLE, "op13_source_divergence": source_divergence.ORACLE}
