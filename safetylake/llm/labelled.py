"""Bounded training samples: labelled documents that are not held out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safetylake.llm.common import hash_sample, held_out, text_of


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """text and label (0 or 1) of about ``rows`` labelled documents whose id is not held out.

    The labels are sampled by a hash of the id before the join, so the broadcast side has about ``rows``
    small rows whatever the tables' size. Of several labels of a document the largest counts, and of several
    documents with one id the smallest text, so that the sample is bounded however often an id is repeated.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    picked = hash_sample(known, "doc_id", rows, known.count())
    known = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(picked), "doc_id")
    return known.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label")).select("text", "label")
