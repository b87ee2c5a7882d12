"""Queries and SQL of this subpackage, for the driver's entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tollgate.llm import (
    collocations_query,
    decontaminate_query,
    language_id_query,
    lm_score_query,
    packing_query,
    quality_classifier_query,
    quality_rules_query,
    sharding_query,
    simhash_query,
    suffix_dedup_query,
    token_count_query,
    url_filter_query,
    whitening_query,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_suffix_dedup": suffix_dedup_query.op1_suffix_dedup,
        "op2_lm_score": lm_score_query.op2_lm_score,
        "op3_url_filter": url_filter_query.op3_url_filter,
        "op4_language_mixture": language_id_query.op4_language_mixture,
        "op5_quality_rules": quality_rules_query.op5_quality_rules,
        "op6_decontaminate": decontaminate_query.op6_decontaminate,
        "op7_quality_classifier": quality_classifier_query.op7_quality_classifier,
        "op8_count_viterbi": token_count_query.op8_count_viterbi,
        "op9_best_two_fit": packing_query.op9_best_two_fit,
        "op10_simhash": simhash_query.op10_simhash,
        "op11_collocations": collocations_query.op11_collocations,
        "op12_shard_tree": sharding_query.op12_shard_tree,
        "op13_whitening": whitening_query.op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    """The others are beyond SQL; tests/llm/ holds them against brute force,
    the tokenizers, or held-out accuracy."""
    return {
        "op3_url_filter": url_filter_query.SQL,
        "op5_quality_rules": quality_rules_query.SQL,
        "op6_decontaminate": decontaminate_query.SQL,
        "op11_collocations": collocations_query.SQL,
        "op12_shard_tree": sharding_query.SQL,
    }
