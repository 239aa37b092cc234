"""Hard negatives by segment summaries: rows of another label that score just below an anchor's positives.

Vectors are whole numbers, ``floor(scale * x)``, and a score is their inner product. A vector is cut into segments;
of each the mean and the deviation (the length of what is left without the mean) are stored. In a segment the inner
product is the width times the product of the means, give or take the product of the deviations; sums over the
segments bound a score from both sides. A tile of anchors and rows is bounded with few wide segments first; pairs
that the bounds let into an anchor's best are bounded again with finer segments, and only what remains is scored
exactly. Bounds are wider than rounding, so the result is exact.

Two passes have the same form. The first keeps each anchor's best rows of its own label, its positives. The second
keeps, for each score of a positive, the best rows of other labels from ``floor_percent`` of that score up to it. A
task takes a block of anchors and then reads a chunk of rows as a stream, batch by batch, keeping the best so far,
whose last score rules out more and more rows; its memory holds the block, one batch and a tile. Chunks are dealt by
row number, so labels, ids or vectors that many rows share do not gather, and only best rows leave a task.

Defined results: rows with a null label or vector or a null or non-finite component take no part; a null vec_id is no
anchor and comes after the others in ties; rows that repeat an id are rows of their own, and an anchor is not its own
positive, but another row with its id may be; vectors of different lengths have no score with each other; numbers and
scores beyond a long stay at its ends; an anchor without positives, or a positive without negatives, gives no rows; an
empty table gives none; only vec_id, embedding and label are read, so other columns of any name are left aside.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from safetylake.session import stage_table

SCALE = 256
POSITIVES = NEGATIVES = 5
FLOOR_PERCENT = 80
SEGMENTS = (4, 16)  # numbers of segments, one level after the other
BLOCK = 16384  # anchors of a task
CHUNK = 131072  # rows that a task reads for them, on a table of any size
LEAST_CHUNK = 2048  # rows of a chunk on tables too small to fill the tasks otherwise
TILE = 1 << 20  # pairs bounded at once
DENSE = 0.1  # share of a tile above which it is scored whole and not pair by pair
EXACT = float(1 << 53)
LONG = (1 << 63) - 1
ANCHORED = "anchor long, bar long, score long, vec_id long, nr long"


def usable_rows(vectors: DataFrame, scale: int, label: Column) -> DataFrame:
    """nr, vec_id, label, v: the rows that take part, numbered, with whole components."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
    rows = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    whole = F.transform("embedding", lambda x: F.floor(F.least(F.greatest(x * F.lit(float(scale)), F.lit(-9.3e18)), F.lit(9.3e18))))
    return rows.select(F.monotonically_increasing_id().alias("nr"), "vec_id", label.alias("label"), whole.alias("v"))


@dataclass
class Side:
    """Vectors of one length with their summaries, level by level."""

    v: np.ndarray
    label: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]] = field(init=False)
    x: np.ndarray = field(init=False)
    size: np.ndarray = field(init=False)

    def __post_init__(self):
        n, d = self.v.shape
        self.x = self.v.astype(np.float64)
        self.size = np.sqrt(np.einsum("ij,ij->i", self.x, self.x))
        self.levels = []
        for s in sorted({min(s, d) for s in SEGMENTS if d}):
            cuts = np.linspace(0, d, s + 1).astype(int)
            widths = np.diff(cuts)
            mean = np.add.reduceat(self.x, cuts[:-1], axis=1) / widths
            rest = self.x - np.repeat(mean, widths, axis=1)
            self.levels.append((mean * np.sqrt(widths), np.sqrt(np.add.reduceat(rest * rest, cuts[:-1], axis=1))))


def exact_pairs(a: Side, b: Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of rows i of a with rows j of b as long."""
    if a.size.max(initial=0) * b.size.max(initial=0) < EXACT:
        out = np.empty(len(i), dtype=np.int64)
        for at in range(0, len(i), 65536):
            part = slice(at, at + 65536)
            out[part] = np.einsum("ij,ij->i", a.x[i[part]], b.x[j[part]]).astype(np.int64)
        return out
    sums = (sum(int(x) * int(y) for x, y in zip(a.v[p], b.v[q], strict=True)) for p, q in zip(i, j, strict=True))
    return np.array([max(-LONG - 1, min(LONG, s)) for s in sums], dtype=np.int64)


def candidates(a: Side, b: Side, lower: np.ndarray, upper: np.ndarray, allowed: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score) of the allowed pairs with scores in [lower, upper] that can be among a row's ``keep`` best.

    ``lower`` and ``upper`` belong to the rows of a.
    """
    none = np.zeros(0, dtype=np.int64)
    slack = 1e-9 * a.size[:, None] * b.size.max(initial=0) + 1e-3
    i = j = None
    for mean_dev_a, mean_dev_b in zip(a.levels, b.levels, strict=True):
        (ma, da), (mb, db) = mean_dev_a, mean_dev_b
        if i is None:
            middle, spread = ma @ mb.T, da @ db.T + slack
            low, high = np.minimum(middle - spread, LONG), np.maximum(middle + spread, -LONG - 1)  # as scores are kept
            fit = allowed & (high >= lower[:, None]) & (low <= upper[:, None])
            # a bound of the keep-th best from below: pairs that are inside for certain
            certain = np.where(allowed & (low >= lower[:, None]) & (high <= upper[:, None]), low, -np.inf)
            if certain.shape[1] >= keep:
                fit &= high >= np.partition(certain, -keep, axis=1)[:, -keep][:, None]
            if fit.mean() > DENSE:
                break
            i, j = np.nonzero(fit)
        else:
            middle = np.einsum("ij,ij->i", ma[i], mb[j])
            spread = np.einsum("ij,ij->i", da[i], db[j]) + slack[i, 0]
            fit = (np.maximum(middle + spread, -LONG - 1) >= lower[i]) & (np.minimum(middle - spread, LONG) <= upper[i])
            i, j = i[fit], j[fit]
    if i is None:  # most of the tile remains (or vectors have no components): one product of matrices
        rows, columns = np.nonzero(allowed) if not a.levels else np.nonzero(fit)
        if a.size.max(initial=0) * b.size.max(initial=0) < EXACT:
            score = (a.x @ b.x.T)[rows, columns].astype(np.int64)
        else:
            score = exact_pairs(a, b, rows, columns)
        i, j = rows, columns
    else:
        score = exact_pairs(a, b, i, j)
    if not len(i):
        return none, none, none
    fit = (score >= lower[i]) & (score <= upper[i])
    return i[fit], j[fit], score[fit]


class Best:
    """The ``keep`` best rows of every question of a block: most score, then smallest vec_id (null last), then row."""

    def __init__(self, n: int, keep: int):
        self.keep = keep
        self.found = np.zeros((0, 4), dtype=np.int64)  # question, score, vec_id, nr
        self.null = np.zeros(0, dtype=bool)
        self.bar = np.full(n, -LONG - 1, dtype=np.int64)

    def add(self, question: np.ndarray, score: np.ndarray, vec_id: np.ndarray, null: np.ndarray, nr: np.ndarray) -> None:
        if not len(question):
            return
        rows = np.concatenate([self.found, np.stack([question, score, vec_id, nr], axis=1)])
        null = np.concatenate([self.null, null])
        order = np.lexsort((rows[:, 3], rows[:, 2], null, -rows[:, 1], rows[:, 0]))
        rows, null = rows[order], null[order]
        firsts = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0]))
        place = np.arange(len(rows)) - np.repeat(firsts, np.diff(np.append(firsts, len(rows))))
        full = place == self.keep - 1
        self.bar[rows[full, 0]] = rows[full, 1]
        self.found, self.null = rows[place < self.keep], null[place < self.keep]


class Meeting:
    """One block of anchors that meets a stream of rows.

    A question is an anchor and a bar: the score that answers must not exceed (null in the first pass, where
    the anchor's own label is asked for instead of others).
    """

    def __init__(self, anchors: list[tuple], keep: int, floor_percent: int | None):
        self.keep, self.same = keep, floor_percent is None
        self.nrs = np.array([a[0] for a in anchors], dtype=np.int64)
        self.by_length: dict[int, tuple[Side, np.ndarray, np.ndarray, np.ndarray]] = {}
        bars = [[None] if self.same else a[3] for a in anchors]
        self.asked = [(n, bar) for n, own in enumerate(bars) for bar in own]
        lengths: dict[int, list[int]] = {}
        for q, (n, _) in enumerate(self.asked):
            lengths.setdefault(len(anchors[n][2]), []).append(q)
        for d, questions in lengths.items():
            of = np.array([self.asked[q][0] for q in questions])
            side = Side(np.array([anchors[n][2] for n in of], dtype=np.int64).reshape(len(of), d), np.array([anchors[n][1] for n in of]))
            low = [-LONG - 1 if self.same else -(-floor_percent * self.asked[q][1] // 100) for q in questions]
            high = [LONG if self.same else self.asked[q][1] for q in questions]
            self.by_length[d] = side, np.array(questions), np.array(low, dtype=np.int64), np.array(high, dtype=np.int64)
        self.best = Best(len(self.asked), keep)

    def read(self, nr: np.ndarray, vec_id: np.ndarray, null: np.ndarray, label: np.ndarray, vectors: pa.ListArray) -> None:
        lengths = vectors.value_lengths().to_numpy()
        for d in np.unique(lengths):
            if d not in self.by_length:
                continue
            at = np.flatnonzero(lengths == d)
            rows = Side(vectors.take(pa.array(at)).flatten().to_numpy().reshape(len(at), d), label[at])
            side, questions, low, high = self.by_length[d]
            step = max(1, TILE // len(at))
            for first in range(0, len(questions), step):
                part = slice(first, first + step)
                tile = Side.__new__(Side)
                tile.v, tile.x, tile.size = side.v[part], side.x[part], side.size[part]
                tile.levels = [(m[part], s[part]) for m, s in side.levels]
                equal = side.label[part][:, None] == rows.label[None, :]
                own = self.nrs[[self.asked[q][0] for q in questions[part]]][:, None] == nr[at][None, :]
                lower = np.maximum(low[part], self.best.bar[questions[part]])
                i, j, score = candidates(tile, rows, lower, high[part], equal & ~own if self.same else ~equal, self.keep)
                j = at[j]
                self.best.add(questions[part][i], score, vec_id[j], null[j], nr[j])

    def answers(self) -> Iterator[tuple]:
        for (q, score, vec_id, nr), null in zip(self.best.found.tolist(), self.best.null, strict=True):
            n, bar = self.asked[q]
            yield int(self.nrs[n]), bar, score, None if null else vec_id, nr


def meet(rows: DataFrame, anchors: DataFrame, chunks: int, blocks: int, keep: int, floor_percent: int | None) -> DataFrame:
    """ANCHORED: for each anchor (and bar) its ``keep`` best rows."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("nr"), F.lit(n)).cast("int")
    left = anchors.select(dealt(blocks).alias("block"), every(chunks).alias("chunk"), F.lit(0).alias("kind"), "nr", "vec_id", "label", "v", "bars")
    right = rows.select(
        every(blocks).alias("block"), dealt(chunks).alias("chunk"), F.lit(1).alias("kind"), "nr", "vec_id", "label", "v",
        F.lit(None).cast("array<bigint>").alias("bars"),
    )
    names = [x.split(" ")[0] for x in ANCHORED.split(", ")]

    def packed(found: Iterable[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, waiting, meeting = None, [], None
        for batch in batches:
            block, chunk, kind = (batch.column(k).to_numpy() for k in range(3))
            change = np.flatnonzero((np.diff(block) != 0) | (np.diff(chunk) != 0) | (np.diff(kind) != 0)) + 1
            edges = [0, *change.tolist(), len(batch)]
            for first, last in zip(edges, edges[1:], strict=False):
                here = (block[first], chunk[first])
                if here != place:
                    if meeting:
                        yield packed(meeting.answers())
                    place, waiting, meeting = here, [], None
                part = batch.slice(first, last - first)
                if kind[first] == 0:
                    waiting += zip(*(part.column(k).to_pylist() for k in (3, 5, 6, 7)), strict=True)
                elif waiting or meeting:
                    if meeting is None:
                        meeting, waiting = Meeting(waiting, keep, floor_percent), []
                    ids = part.column(4)
                    meeting.read(
                        part.column(3).to_numpy(), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False),
                        part.column(5).to_numpy(), part.column(6),
                    )
        if meeting:
            yield packed(meeting.answers())

    met = left.unionByName(right).repartition(chunks * blocks, "block", "chunk").sortWithinPartitions("block", "chunk", "kind")
    found = met.mapInArrow(run, ANCHORED)
    order = Window.partitionBy("anchor", "bar").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "nr")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    label: Column | None = None,
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    floor_percent: int = FLOOR_PERCENT,
    block: int = BLOCK,
    chunk: int = CHUNK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows that ``anchors`` selects.

    ``label`` may replace the column of that name.
    """
    spark = vectors.sparkSession
    rows = stage_table(usable_rows(vectors, scale, F.col("label") if label is None else label.cast("long")), "vectors")
    asking = rows.where(F.coalesce(anchors, F.lit(False)))
    sizes = rows.agg(F.count("*").alias("n"), F.count(F.when(F.coalesce(anchors, F.lit(False)), 1)).alias("a")).first()
    wanted = min(2 * spark.sparkContext.defaultParallelism, -(-sizes["n"] // LEAST_CHUNK))
    chunks, blocks = max(1, wanted, -(-sizes["n"] // chunk)), max(1, -(-sizes["a"] // block))
    first = meet(rows, asking.withColumn("bars", F.lit(None).cast("array<bigint>")), chunks, blocks, positives, None)
    first = stage_table(first.select("anchor", F.col("score").alias("positive_score"), F.col("vec_id").alias("positive_id")), "positives")
    bars = first.groupBy("anchor").agg(F.collect_set("positive_score").alias("bars"))  # a few scores for each anchor
    second = meet(rows, asking.join(bars, F.col("nr") == F.col("anchor")), chunks, blocks, negatives, floor_percent)
    second = second.select("anchor", "bar", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = first.join(asking.select(F.col("nr").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    met = named.withColumnRenamed("positive_score", "bar").join(second, ["anchor", "bar"])
    return met.select("anchor_id", "positive_id", "rank", "negative_id", F.col("bar").alias("positive_score"), "negative_score")


def op12_hard_negatives(vectors: DataFrame) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0, label)


#: DuckDB SQL for op12_hard_negatives over ``embeddings``.
SQL = """
WITH r AS (
  SELECT row_number() OVER () AS nr, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT a.nr AS anchor, a.vec_id AS anchor_id, a.label AS anchor_label, a.v AS anchor_v, b.vec_id AS positive_id,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS positive_score
  FROM r a JOIN r b ON a.label = b.label AND a.nr <> b.nr
  WHERE a.vec_id % 100 = 0
  QUALIFY row_number() OVER (PARTITION BY a.nr ORDER BY list_inner_product(a.v, b.v) DESC, b.vec_id) <= 5),
s AS (
  SELECT a.nr AS anchor, b.vec_id AS negative_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS negative_score
  FROM r a JOIN r b ON a.label <> b.label
  WHERE a.vec_id % 100 = 0),
n AS (
  SELECT p.anchor_id, p.positive_id, s.negative_id, p.positive_score, s.negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.positive_id ORDER BY s.negative_score DESC, s.negative_id) AS rank
  FROM p JOIN s USING (anchor)
  WHERE 80 * p.positive_score <= 100 * s.negative_score AND s.negative_score <= p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
