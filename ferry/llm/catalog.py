"""Queries of the operators, one per operator, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ferry.llm import (
    alignment,
    bpe,
    decontaminate,
    hard_negatives,
    licenses,
    neardup,
    packing,
    quality_model,
    quality_rules,
    sharding,
    token_counts,
    token_files,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe_encode": bpe.op1_bpe_encode,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_sharding": sharding.op4_sharding,
    "op5_minhash_dedup": neardup.op5_minhash_dedup,
    "op6_license_scan": licenses.op6_license_scan,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_token_files": token_files.op8_token_files,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_quality_model": quality_model.op10_quality_model,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_token_alignment": alignment.op12_token_alignment,
    "op13_mixture_packing": packing.op13_mixture_packing,
}
ORACLE_SQL: dict[str, str] = {
    "op5_minhash_dedup": neardup.ORACLE_SQL,
    "op9_quality_rules": quality_rules.ORACLE_SQL,
    "op11_hard_negatives": hard_negatives.ORACLE_SQL,
}
