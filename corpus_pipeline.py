"""A training corpus from ``documents``: quality, near duplicates, secrets, mixture, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as Parquet in the
shared folder and reads it back as the next stage's docs, so a lost executor costs a re-read at most. All
stages but the last return the columns of documents.

Defined results of every stage: texts of any length are read whole; an empty table gives an empty one; extra columns go
through, whatever their names, but for packing, which reads doc_id and text only. Null and empty texts are scored like others
by quality, are near duplicates of nothing, hold no secrets, have size 0 and so take no part in the mix. A null doc_id or
source is carried along (a null source is a source of its own), and its row is never learned from. Repeated rows are judged
alike; near_duplicates keeps one of them, by id and then by text. Ties are broken by id, then by a hash of the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from safetylake.llm import mixing, near_dup, packing, quality, secret_scan
from safetylake.llm.common import table
from safetylake.session import stage_table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return near_dup.deduplicated(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts."""
    return secret_scan.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and cuts the sources to their target weights, in the order of the mix."""
    return mixing.mixed_documents(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows: one row per piece with its ids and its place."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: The classifier and the differencing cannot be written in SQL; tests/llm compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
