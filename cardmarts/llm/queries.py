"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cardmarts.llm import (
    cross_polytope,
    divergence,
    exact_dedup,
    filter_audit,
    language_id,
    mixing,
    pii,
    prob_minhash,
    quality_rules,
    sentencepieces,
    toxicity,
    url_reputation,
    warc_index,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_index": warc_index.op1_warc_index,
    "op2_prob_minhash": prob_minhash.op2_prob_minhash,
    "op3_cross_polytope": cross_polytope.op3_cross_polytope,
    "op4_url_reputation": url_reputation.op4_url_reputation,
    "op5_language_id": language_id.op5_language_id,
    "op6_pii": pii.op6_pii,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_sentencepiece": sentencepieces.op8_sentencepiece,
    "op9_mixing": mixing.op9_mixing,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_divergence_audit": divergence.op11_divergence_audit,
    "op12_toxicity": toxicity.op12_toxicity,
    "op13_filter_interaction": filter_audit.op13_filter_interaction,
}

ORACLE_SQL: dict[str, str] = {
    "op1_warc_index": warc_index.OP1_SQL,
    "op7_exact_dedup": exact_dedup.OP7_SQL,
    "op11_divergence_audit": divergence.OP11_SQL,
    "op13_filter_interaction": filter_audit.OP13_SQL,
}
