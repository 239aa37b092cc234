"""Approximate nearest neighbours by multi-index hashing.

A rotation is learned on a bounded sample (iterative quantisation: principal axes, then the rotation that
brings the sample closest to its signs). A vector's code is the signs of its rotated form, split into
substrings of 16 bits, each with an inverted index. Two codes within Hamming distance r agree within r / m
bits on one of m substrings, so probing each index to that distance finds every code within r; those are
ranked by the exact cosine of the original vectors.

The radius is the distance within which ``aim`` of the true neighbours of sample queries lie. Every row is
indexed: rows are dealt by hash into chunks of about ``chunk`` rows, the queries into blocks of about
``block``; a task gets one chunk and one block, and each query keeps its k best of a chunk, so a task's
memory does not depend on the table's size, and a vector that many rows share does not gather anywhere.

Defined results: null, all-zero vectors, and those with a null or non-finite component or another length
than most of the sample take no part, nor do null ids; rows that repeat an id are rows of their own, as
candidates and as queries, and only its own row is no candidate of a query; equal scores go to the smaller id;
an empty table gives no rows; a query with fewer than k candidates gets them all; only vec_id and embedding are read, so other columns of any name are left aside.
"""

from __future__ import annotations

import statistics

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from safetylake.llm.common import hash_sample
from safetylake.session import stage_table

SAMPLE = 4096  # rows the rotation and the radius are fitted on, about as many
BITS, SUB = 64, 16
CHUNK, BLOCK = 16384, 65536
AIM = 0.985
POP = np.array([i.bit_count() for i in range(1 << SUB)], dtype=np.uint8)


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def learn_rotation(x: np.ndarray, bits: int = BITS, rounds: int = 30) -> np.ndarray:
    """Projection (dimensions, bits) for unit rows ``x``."""
    _, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, ::-1][:, : min(bits, x.shape[1])]
    v = x @ axes
    rotation, _ = np.linalg.qr(np.random.default_rng(7).standard_normal((v.shape[1],) * 2))
    for _ in range(rounds):
        left, _, right = np.linalg.svd(v.T @ np.where(v @ rotation >= 0, 1.0, -1.0))
        rotation = left @ right
    return axes @ rotation


def codes_of(x: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """Codes as rows of 16-bit substrings; missing bits are 0."""
    bits = np.zeros((len(x), -(-rotation.shape[1] // SUB) * SUB), dtype=np.uint8)
    bits[:, : rotation.shape[1]] = x @ rotation >= 0
    return np.packbits(bits, axis=1).view(np.uint16)


def fit(x: np.ndarray, k: int, aim: float = AIM) -> tuple[np.ndarray, int]:
    """(rotation, radius) for sample rows ``x``."""
    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    rotation = learn_rotation(unit)
    codes = codes_of(unit, rotation)
    found = []
    for i in range(min(256, len(x))):
        near = unit @ unit[i]
        near[i] = -2
        best = np.argsort(-near)[: min(k, len(x) - 1)]
        found.append(POP[codes[best] ^ codes[i]].sum(axis=1))
    return rotation, int(np.quantile(np.concatenate(found), aim, method="higher")) if len(x) > 1 else BITS


class Index:
    """Inverted indexes over the substrings of one chunk."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.lists = []
        for s in range(codes.shape[1]):
            order = np.argsort(codes[:, s], kind="stable")
            values, starts, counts = np.unique(codes[order, s], return_index=True, return_counts=True)
            self.lists.append((order, values, starts, counts))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Row numbers of all codes at most ``radius`` bits away."""
        reach = radius // len(self.lists)
        seen = np.zeros(len(self.codes), dtype=bool)
        for (order, values, starts, counts), part in zip(self.lists, code, strict=True):
            hit = np.flatnonzero(POP[values ^ part] <= reach)
            sizes = counts[hit]
            first = np.cumsum(sizes) - sizes
            seen[order[np.arange(sizes.sum()) + np.repeat(starts[hit] - first, sizes)]] = True
        rows = np.flatnonzero(seen)
        return rows[POP[self.codes[rows] ^ code].sum(axis=1) <= radius]


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in vectors.chunks]).to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def search_chunk(rows: pa.Table, queries: pa.Table, rotation: np.ndarray, radius: int, k: int) -> list[tuple]:
    """(query, query_id, vec_id, nr, score): each query's k best rows of one chunk, ties to the smaller id."""
    x, q = _matrix(rows["embedding"]), _matrix(queries["embedding"])
    ids, nrs = rows["vec_id"].to_numpy(), rows["nr"].to_numpy()
    length, q_length = (np.sqrt(np.einsum("ij,ij->i", m, m)) for m in (x, q))
    index, q_codes = Index(codes_of(x, rotation)), codes_of(q, rotation)
    out = []
    for i, (query, query_id) in enumerate(zip(queries["nr"].to_pylist(), queries["vec_id"].to_pylist(), strict=True)):
        reach = radius
        while True:
            found = index.within(q_codes[i], reach)
            found = found[nrs[found] != query]
            if len(found) >= k or reach >= BITS:
                break
            reach += index.codes.shape[1]
        score = np.einsum("ij,j->i", x[found], q[i]) / (length[found] * q_length[i])
        best = np.lexsort((nrs[found], ids[found], -score))[:k]
        out += [(query, query_id, int(ids[found[b]]), int(nrs[found[b]]), float(score[b])) for b in best]
    return out


def nearest(
    vectors: DataFrame, queries: Column, k: int = 5, sample: int = SAMPLE, chunk: int = CHUNK, block: int = BLOCK
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for every row that ``queries`` selects."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = stage_table(rows.withColumn("nr", F.monotonically_increasing_id()), "vectors")  # numbers rows for good
    sizes = rows.agg(F.count("*").alias("n"), F.count(F.when(queries, 1)).alias("q")).first()
    picked = hash_sample(rows, "nr", sample, sizes["n"]).select("embedding").collect()
    schema = "query long, query_id long, vec_id long, nr long, score double"
    if not picked:
        found = rows.sparkSession.createDataFrame([], schema)
    else:
        size = statistics.mode(len(r[0]) for r in picked)
        rotation, radius = fit(np.array([r[0] for r in picked if len(r[0]) == size]), k)
        rows = rows.where(F.size("embedding") == size)
        chunks, blocks = max(1, -(-sizes["n"] // chunk)), max(1, -(-sizes["q"] // block))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        dealt = lambda n: F.pmod(F.xxhash64("nr"), F.lit(n)).cast("int")
        left = rows.select("*", dealt(chunks).alias("chunk"), every(blocks).alias("block"))
        fresh = [F.col(c).alias(c) for c in rows.columns]  # columns that are not the left side's own
        right = rows.where(queries).select(*fresh).select("*", dealt(blocks).alias("block"), every(chunks).alias("chunk"))

        def search(a: pa.Table, b: pa.Table) -> pa.Table:
            made = search_chunk(a, b, rotation, radius, k) if a.num_rows and b.num_rows else []
            columns = zip(*made, strict=True) if made else [[]] * 5
            types = [*[pa.int64()] * 4, pa.float64()]
            names = ["query", "query_id", "vec_id", "nr", "score"]
            return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        found = left.groupBy("chunk", "block").cogroup(right.groupBy("chunk", "block")).applyInArrow(search, schema)
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "nr"))
    return found.select("query_id", place.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def op8_nearest(vectors: DataFrame) -> DataFrame:
    return nearest(vectors, F.col("vec_id") % 50 == 0)
