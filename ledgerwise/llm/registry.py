"""Queries and oracle SQL of the operators in this subpackage."""

from __future__ import annotations

from typing import Callable, Dict

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from ledgerwise.llm import alignment, bpe, embedding_dedup, language, line_dedup, merkle, mixing, near_dup, packing, quality, secrets, sharding, topk

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> Dict[str, Query]:
    return {
        "op1_secrets": secrets.op1_secrets,
        "op2_sharding": sharding.op2_sharding,
        "op3_language": language.op3_language,
        "op4_line_dedup": line_dedup.op4_line_dedup,
        "op5_packing": packing.op5_packing,
        "op6_quality": quality.op6_quality,
        "op7_embedding_dedup": embedding_dedup.op7_embedding_dedup,
        "op8_mixing": mixing.op8_mixing,
        "op9_topk": topk.op9_topk,
        "op10_near_dup": near_dup.op10_near_dup,
        "op11_alignment": alignment.op11_alignment,
        "op12_merkle": merkle.op12_merkle,
        "op13_bpe": bpe.op13_bpe,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> Dict[str, str]:
    return {
        "op2_sharding": sharding.SQL,
        "op4_line_dedup": line_dedup.SQL,
        "op7_embedding_dedup": embedding_dedup.SQL,
        "op9_topk": topk.SQL,
        "op12_merkle": merkle.SQL,
    }
