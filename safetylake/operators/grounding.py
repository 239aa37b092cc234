"""Nearest dictionary terms of event verbatims by cosine of their vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from safetylake import schemas as S
from safetylake.functions import text
from safetylake.operators.postings import Postings, scaled
from safetylake.session import stage_table

BLOCK_BYTES = 64 << 20
SLICE_ROWS = 1 << 18
SCORE_DIGITS = 9
WEIGHT_DIGITS = 9
UNKNOWN = -1  # the slot of all trigrams that the model does not hold


def trigrams(term: Column) -> Column:
    """The character trigrams of the normalised term, with a space around it."""
    padded = F.concat(F.lit(" "), text.normalize_pt(term), F.lit(" "))
    places = F.sequence(F.lit(1), F.greatest(F.length(padded) - 2, F.lit(1)))
    return F.transform(places, lambda i: F.substring(padded, i, 3))


def fit_vectors(terms: DataFrame, column: str) -> DataFrame:
    """The vector model of a dictionary: gram, slot, n_terms and weight of every trigram of its distinct terms.

    A trigram weighs ``ln((1 + terms) / (1 + terms that hold it)) + 1``; ``n_terms`` of the row without a gram
    is the number of terms, and its weight that of a trigram that no term holds. Slots number the trigrams in order.
    Trigrams are as many as a language has, whatever the number of terms.
    """
    distinct = terms.select(column).filter(F.col(column).isNotNull()).distinct()
    counted = distinct.select(F.explode(F.array_distinct(trigrams(F.col(column)))).alias("gram")).groupBy("gram").agg(F.count("*").alias("n_terms"))
    total = distinct.agg(F.count("*").alias("total"))
    weight = F.round(F.log((1 + F.col("total")) / (1 + F.col("n_terms"))) + 1, WEIGHT_DIGITS)
    slot = (F.row_number().over(Window.orderBy("gram")) - 1).cast("int")
    known = counted.withColumn("slot", slot).crossJoin(total).select("gram", "slot", "n_terms", weight.alias("weight"))
    other = total.select(
        F.lit(None).cast("string").alias("gram"), F.lit(UNKNOWN).alias("slot"), F.col("total").alias("n_terms"),
        F.round(F.log(1.0 + F.col("total")) + 1, WEIGHT_DIGITS).alias("weight"),
    )
    return known.unionByName(other)


def embed_terms(terms: DataFrame, column: str, model: DataFrame) -> DataFrame:
    """Distinct terms of a column with their sparse unit vector: struct of slots (ascending) and weights.

    A weight is the trigram's count in the term times its weight in ``model`` (of ``fit_vectors``, written
    once). What the model does not hold adds to the length of the vector and stands in the slot UNKNOWN.
    A term is read once, and its trigrams meet in one aggregation.
    """
    counts = terms.select(column).distinct().select(column, F.explode(trigrams(F.col(column))).alias("gram")).groupBy(column, "gram").agg(F.count("*").alias("n"))
    other = model.filter("gram is null").select(F.col("weight").alias("other"))
    known = model.filter("gram is not null").select("gram", "slot", "weight")
    rows = counts.join(known, "gram", "left").crossJoin(other).select(
        column, F.coalesce("slot", F.lit(UNKNOWN)).alias("slot"), (F.col("n") * F.coalesce("weight", "other")).alias("weight")
    )
    pair = F.struct("slot", "weight")
    grouped = rows.groupBy(column).agg(
        F.array_sort(F.collect_list(F.when(F.col("slot") != UNKNOWN, pair))).alias("pairs"),
        F.sum(F.when(F.col("slot") == UNKNOWN, F.col("weight") * F.col("weight"))).alias("unknown"),
    )
    first = F.when(F.col("unknown").isNotNull(), F.array(F.struct(F.lit(UNKNOWN).alias("slot"), F.sqrt("unknown").alias("weight"))))
    grouped = grouped.withColumn("pairs", F.concat(F.coalesce(first, F.array().cast("array<struct<slot:int,weight:double>>")), "pairs"))
    length = F.sqrt(F.aggregate("pairs", F.lit(0.0), lambda total, p: total + p["weight"] * p["weight"]))
    weights = F.transform("pairs", lambda p: F.round(p["weight"] / F.col("length"), WEIGHT_DIGITS))
    vector = F.struct(F.col("pairs.slot").alias("slots"), weights.alias("weights"))
    return grouped.withColumn("length", length).select(column, vector.alias("vector"))


def nearest_to(verbatims: DataFrame, dictionary: DataFrame, k: int) -> DataFrame:
    """``ground_topk`` of verbatims and dictionary terms by vectors fitted on the dictionary."""
    model = stage_table(fit_vectors(dictionary, "pt_term"), "vector-model")
    return ground_topk(embed_terms(verbatims, "verbatim", model), embed_terms(dictionary, "pt_term", model), k)


def _sparse(rows: DataFrame, key: str) -> DataFrame:
    """key, slots, weights of the rows that have a vector, be it an array of numbers or a struct of the two."""
    rows = rows.filter(F.col("vector").isNotNull()).dropDuplicates([key])
    if isinstance(rows.schema["vector"].dataType, T.StructType):
        return rows.select(key, F.col("vector.slots").cast("array<int>").alias("slots"), F.col("vector.weights").cast("array<double>").alias("weights"))
    pairs = F.filter(
        F.transform("vector", lambda x, i: F.struct(i.alias("slot"), x.cast("double").alias("weight"))), lambda p: p["weight"] != 0
    )
    return rows.select(key, pairs.alias("pairs")).select(key, F.col("pairs.slot").alias("slots"), F.col("pairs.weight").alias("weights"))


def _vectors(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, slots and weights of the rows of a batch (block, slice, kind, name, slots, weights)."""
    sizes = batch.column(4).value_lengths().to_numpy()
    return np.append(0, np.cumsum(sizes)), batch.column(4).flatten().to_numpy().astype(np.int64), batch.column(5).flatten().to_numpy()


class Matching:
    """One block of terms that meets verbatims batch by batch."""

    def __init__(self, batches: list[pa.RecordBatch], k: int, digits: int):
        parts = [_vectors(b) for b in batches]
        self.names = [n for b in batches for n in b.column(3).to_pylist()]
        sizes = np.concatenate([np.diff(p[0]) for p in parts])
        self.index = Postings(np.append(0, np.cumsum(sizes)), *(np.concatenate([p[i] for p in parts]) for i in (1, 2)))
        self.k, self.digits = k, digits

    def tops(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        starts, slots, weights = _vectors(batch)
        weights = scaled(starts, weights)
        queries = [(slots[a:b], weights[a:b]) for a, b in zip(starts, starts[1:], strict=False)]
        if self.index.full:
            found = self.index.search_full(queries, self.k, self.digits)
        else:
            found = [self.index.search(*q, self.k, self.digits) for q in queries]
        verbatims = [v for v, (rows, _) in zip(batch.column(3).to_pylist(), found, strict=True) for _ in rows]
        terms = [self.names[i] for rows, _ in found for i in rows]
        scores = np.concatenate([s for _, s in found]) + 0.0  # no negative zero
        return pa.RecordBatch.from_arrays([pa.array(verbatims, pa.string()), pa.array(terms, pa.string()), pa.array(scores)], ["verbatim", "pt_term", "score"])


def ground_topk(
    queries: DataFrame,
    terms: DataFrame,
    k: int = S.TOP_K_TERMS,
    block_bytes: int = BLOCK_BYTES,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Exact ``k`` nearest terms per distinct verbatim: (verbatim, rank, pt_term, score).

    ``queries`` holds (verbatim, vector) and ``terms`` (pt_term, vector); a vector is an array of numbers or a
    struct of slots and weights, and rows without one take no part. Terms are dealt by hash into blocks of about
    ``block_bytes``, verbatims into slices of about ``slice_rows`` (fewer rows where tasks would stay idle). A task
    builds an inverted index of its block and then reads its slice as a stream, so it holds one block and one
    batch whatever the tables' sizes; the index skips the terms whose bound is below the top so far. No
    (verbatim, term) pair outside a block's top is ever a row.
    """
    queries, terms = _sparse(queries, "verbatim"), _sparse(terms, "pt_term")
    size = terms.agg(
        F.coalesce(F.sum(36 * F.size("slots") + F.length("pt_term") + 64), F.lit(0)).alias("bytes")
    ).first()["bytes"]
    n, spare = queries.count(), queries.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, math.ceil(size / block_bytes))
    slices = max(1, math.ceil(n / slice_rows), min(math.ceil(spare / blocks), math.ceil(n / 1024)))

    def dealt(key: str, n: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = terms.select(dealt("pt_term", blocks).alias("block"), every(slices).alias("slice"), F.lit(0).alias("kind"), F.col("pt_term").alias("name"), "slots", "weights")
    right = queries.select(every(blocks).alias("block"), dealt("verbatim", slices).alias("slice"), F.lit(1).alias("kind"), F.col("verbatim").alias("name"), "slots", "weights")
    met = left.unionByName(right).repartition(blocks * slices, "block", "slice").sortWithinPartitions("block", "slice", "kind", "name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, waiting, matching = None, [], None
        for batch in batches:
            block, part, kind = (batch.column(i).to_numpy() for i in range(3))
            change = np.flatnonzero((np.diff(block) != 0) | (np.diff(part) != 0) | (np.diff(kind) != 0)) + 1
            edges = [0, *change.tolist(), len(batch)]
            for first, last in zip(edges, edges[1:], strict=False):
                if (block[first], part[first]) != place:
                    place, waiting, matching = (block[first], part[first]), [], None
                rows = batch.slice(first, last - first)
                if kind[first] == 0:
                    waiting.append(rows)
                elif waiting or matching:
                    if matching is None:
                        matching, waiting = Matching(waiting, k, SCORE_DIGITS), []
                    yield matching.tops(rows)

    tops = met.mapInArrow(run, "verbatim string, pt_term string, score double")
    best = Window.partitionBy("verbatim").orderBy(F.col("score").desc(), "pt_term")
    return (
        tops.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("verbatim", "rank", "pt_term", "score")
    )


def candidate_lists(queries: DataFrame, tops: DataFrame) -> DataFrame:
    """One row per verbatim with its candidates, best first; none gives an empty list."""
    lists = tops.groupBy("verbatim").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "pt_term"))), lambda c: c["pt_term"]
        ).alias("candidates")
    )
    empty = F.array().cast("array<string>")
    return (
        queries.select("verbatim")
        .distinct()
        .join(lists, "verbatim", "left")
        .select("verbatim", F.coalesce("candidates", empty).alias("candidates"))
    )


def ground_null(queries: DataFrame) -> DataFrame:
    """No grounding: every verbatim with an empty candidate list."""
    return queries.select("verbatim").distinct().withColumn(
        "candidates", F.array().cast("array<string>")
    )
