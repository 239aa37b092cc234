"""The named queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from safetylake.llm import chat, extraction, hard_negatives, mixing, near_dup, nearest, packing, quality, secret_scan, spelling, spotsigs, token_files, toxicity
from safetylake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_mixing": lambda spark, sf: mixing.op1_mixing(table(spark, sf, "documents")),
    "op2_extraction": lambda spark, sf: extraction.op2_extraction(table(spark, sf, "pages")),
    "op3_packing": lambda spark, sf: packing.op3_packing(table(spark, sf, "documents")),
    "op4_secret_scan": lambda spark, sf: secret_scan.op4_secret_scan(table(spark, sf, "documents")),
    "op5_spotsigs": lambda spark, sf: spotsigs.op5_spotsigs(table(spark, sf, "documents")),
    "op6_chat": lambda spark, sf: chat.op6_chat(table(spark, sf, "conversations")),
    "op8_nearest": lambda spark, sf: nearest.op8_nearest(table(spark, sf, "embeddings")),
    "op9_near_dup": lambda spark, sf: near_dup.op9_near_dup(table(spark, sf, "documents")),
    "op10_quality": lambda spark, sf: quality.op10_quality(table(spark, sf, "documents"), table(spark, sf, "labels")),
    "op11_spelling": lambda spark, sf: spelling.op11_spelling(table(spark, sf, "documents")),
    "op12_hard_negatives": lambda spark, sf: hard_negatives.op12_hard_negatives(table(spark, sf, "embeddings")),
    "op13_token_files": lambda spark, sf: token_files.op13_token_files(table(spark, sf, "documents")),
    "op7_toxicity": lambda spark, sf: toxicity.op7_toxicity(table(spark, sf, "documents"), table(spark, sf, "labels")),
}

ORACLE_SQL: dict[str, str] = {"op1_mixing": mixing.SQL, "op12_hard_negatives": hard_negatives.SQL}
