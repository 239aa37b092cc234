"""Near-duplicate groups by a chosen-path set similarity join.

A document is its set of word shingles. Documents with equal sets are one class, found by a hash of the set,
so a group of copies, however large, goes on as one row. Classes then branch down independent trees: at a
node, one minwise coordinate (now and then two) is chosen by the node's own hash, and the class goes on to
the child named by its minwise value there. Similar sets choose alike and keep meeting; unrelated ones part.
The depth is what parts unrelated sets in a table of this size, and the number of trees what lets a pair at
the threshold meet with probability ``recall``.

Rows of a node meet in one task, sorted. Small nodes are compared exhaustively on sketches, which leave a
spanning forest of likely links; in larger nodes rows are compared with a block of pivots, and those that
match none go on among themselves. The likely links make candidate groups. Groups are then settled on full
sets: every link is confirmed on the sets themselves, pairs already connected are skipped, and again only
a forest is kept, so copies of one document cost time in proportion to their number. Groups too large for one
task are dealt by tree nodes instead, and a node with too many rows by pairs of chunks: only rows that its
first block leaves unconnected are compared again, so work grows with the square of those rows alone.
Confirmed links give the components.

A task holds one batch, one node's pivots and what matches none of them, or two chunks of sets; no group, list
of links or label comes to the driver.

Defined results: null and empty texts, and texts of white space alone, have an empty set, are linked with
nothing and are their own component; fewer words than a shingle make one shingle; repeated rows are in one
component; a null doc_id takes the component of its group (null if it has no id at all) and is kept only in
the latter case; an empty table gives no rows; only doc_id and text are read here, other columns of any name
are left aside.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from safetylake.llm.common import text_of
from safetylake.llm.components import components
from safetylake.session import stage_table

PERCENT = 80  # of the union that two sets must share
RECALL = 0.9999  # of pairs at the threshold, over all trees and the sketches, in nodes without pivots
BACKGROUND = 0.08  # similarity up to which unrelated sets are parted
COORDINATES, SKETCH = 96, 32  # minwise values for paths, and others for sketches
ALIKE = 16  # equal sketch bytes of a likely link; four standard deviations below the threshold
PIVOTS = 64
TOGETHER = 512  # classes of a group that one task settles exhaustively
TOGETHER_SIZE = 2_000_000  # and their shingles
CHUNK, CHUNK_SIZE = 4096, 8_000_000  # classes that one task holds at once, and their shingles

U = np.uint64
_RNG = np.random.default_rng(20)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_RADIX = U(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, dtype=np.uint64)
_A = _RNG.integers(1, 2**63, COORDINATES + SKETCH, dtype=np.uint64) * U(2) + U(1)
_B = _RNG.integers(1, 2**63, COORDINATES + SKETCH, dtype=np.uint64)
_INVERSE = U(pow(int(_RADIX), -1, 2**64))
_INVERSES = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = 1 << max(12, n.bit_length())
        _POWERS = np.append(U(1), np.cumprod(np.full(size - 1, _RADIX)))
        _INVERSES = np.append(U(1), np.cumprod(np.full(size - 1, _INVERSE)))
    return _POWERS, _INVERSES


def shingles(text: str, words: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    raw = np.frombuffer(text.encode("utf-8", "replace").lower(), dtype=np.uint8)
    white = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edges = np.flatnonzero(np.diff(np.concatenate(([True], white, [True])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    powers, inverses = _powers(len(raw) + 1)
    total = np.append(U(0), np.cumsum(_BYTE[raw] * powers[: len(raw)]))
    word = mix((total[ends] - total[starts]) * inverses[starts])
    width = min(words, len(word))
    out = word[: len(word) - width + 1].copy()
    for k in range(1, width):
        out = mix(out * U(0xD6E8FEB86659FD93) + word[k : len(word) - width + 1 + k])
    if width < words:
        out = mix(out + U(width))
    return np.unique(out)


def class_of(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def minwise(found: np.ndarray) -> np.ndarray:
    """The minwise values of a set, 32 bits each."""
    least = np.full(len(_A), 2**32 - 1, dtype=np.uint64)
    for at in range(0, len(found), 4096):
        part = found[at : at + 4096]
        least = np.minimum(least, ((part[None, :] * _A[:, None] + _B[:, None]) >> U(32)).min(axis=1))
    return least


def _sketch(values: np.ndarray) -> np.ndarray:
    return (mix(values[..., COORDINATES:]) & U(255)).astype(np.uint8)


def meeting(depth: int, similarity: float) -> float:
    """Probability that two sets meet in one tree at this depth."""
    p = 1.0
    for _ in range(depth):
        x = similarity * p
        p = 0.75 * x + 0.25 * (1 - (1 - x) ** 2)
    return p


def binomial(n: int, p: float) -> list[float]:
    return [math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1)]


def sketch_loss(similarity: float) -> float:
    """Probability that the sketches of two sets share less than ALIKE bytes."""
    return sum(binomial(SKETCH, similarity + (1 - similarity) / 256)[:ALIKE])


def missed(depth: int, trees: int, similarity: float) -> float:
    """Probability that two sets meet in no tree; all trees draw from the same coordinates."""
    shares = enumerate(binomial(COORDINATES, similarity))
    return sum(p * (1 - meeting(depth, k / COORDINATES)) ** trees for k, p in shares)


def forest_size(rows: int, recall: float = RECALL, percent: int = PERCENT) -> tuple[int, int]:
    """(depth, trees) for a table of so many rows, so that trees and sketches together reach ``recall``."""
    depth, similarity, trees = max(3, math.ceil(math.log(max(rows, 2)) / -math.log(BACKGROUND))), percent / 100, 1
    # a recall that the sketches alone do not leave is aimed at by the trees
    allowed = 1 - recall - sketch_loss(similarity)
    allowed = allowed if allowed > 0 else 1 - recall
    while trees < 1000 and missed(depth, trees, similarity) > allowed:
        trees += 1
    return depth, trees


def leaf_nodes(values: np.ndarray, depth: int, trees: int) -> tuple[np.ndarray, np.ndarray]:
    """(row number, node) at the given depth of all trees, for rows of minwise values."""
    row = np.repeat(np.arange(len(values)), trees)
    node = np.tile(mix(np.arange(1, trees + 1, dtype=np.uint64)), len(values))
    for _ in range(depth):
        twice = mix(node + U(3)) & U(3) == U(0)
        row, node, child = (
            np.concatenate([row, row[twice]]), np.concatenate([node, node[twice]]),
            np.concatenate([np.ones(len(node), dtype=np.uint64), np.full(int(twice.sum()), 2, dtype=np.uint64)]),
        )
        place = (mix(node + child) % U(COORDINATES)).astype(np.int64)
        node = mix(node * U(0xD6E8FEB86659FD93) + values[row, place] * U(128) + place.astype(np.uint64))
    return row, node


# --- pass 1: sets, classes, paths ----------------------------------------------------------------------

SETS = "doc_id long, digest binary, n long, cls binary, sketch binary, nodes array<long>"


def _digest() -> Column:
    return F.unhex(F.md5(text_of().cast("binary"))).alias("digest")


def _sets(docs: DataFrame, words: int, depth: int, trees: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = [shingles(t.as_py(), words) for t in part.column(1)]
                values = np.stack([minwise(s) for s in found])
                row, node = leaf_nodes(values, depth, trees)
                order = np.lexsort((node, row))
                row, node = row[order], node[order]
                new = np.append(True, (row[1:] != row[:-1]) | (node[1:] != node[:-1]))
                row, node = row[new], node[new]
                offsets = np.searchsorted(row, np.arange(len(found) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(2), pa.array([len(s) for s in found], pa.int64()),
                        pa.array([class_of(s) for s in found], pa.binary()),
                        pa.array([b.tobytes() for b in _sketch(values)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(node.view(np.int64))),
                    ],
                    ["doc_id", "digest", "n", "cls", "sketch", "nodes"],
                )

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text"), _digest()).mapInArrow(run, SETS)


# --- pass 2: likely links inside nodes -----------------------------------------------------------------


class Union:
    """Connected sets of small integers or keys."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[b] = a
        return a != b


def _same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.count_nonzero(a == b, axis=-1)


def _forest(pairs: np.ndarray) -> np.ndarray:
    union = Union()
    return np.array([p for p in pairs.tolist() if union.join(*p)], dtype=np.int64).reshape(-1, 2)


def small_node_links(node: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Pairs of row numbers, a spanning forest of likely links; rows sorted by node, nodes of few rows."""
    found, step = [], 1
    at = np.flatnonzero(node[1:] == node[:-1])
    while len(at):
        hit = at[_same(sketch[at], sketch[at + step]) >= ALIKE]
        found.append(np.stack([hit, hit + step], axis=1))
        step += 1
        at = at[at + step < len(node)]
        at = at[node[at] == node[at + step]]
    return _forest(np.concatenate(found)) if found else np.zeros((0, 2), dtype=np.int64)


def part_from_pivots(sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(links of rows to their closest pivot, rows that match none); the first rows are the pivots."""
    links, rest = [], []
    for at in range(PIVOTS, len(sketch), 2048):
        same = _same(sketch[at : at + 2048, None, :], sketch[None, :PIVOTS, :])
        best = same.argmax(axis=1)
        ok = same.max(axis=1) >= ALIKE
        rows = np.arange(at, at + len(same))
        links.append(np.stack([rows[ok], best[ok]], axis=1))
        rest.append(rows[~ok])
    return np.concatenate(links), np.concatenate(rest)


def large_node_links(sketch: np.ndarray) -> np.ndarray:
    """Links of a node of any size: to pivots, among pivots, and again among rows that match no pivot."""
    rows, out = np.arange(len(sketch)), []
    while len(rows):
        pivots = rows[:PIVOTS]
        inside = small_node_links(np.zeros(len(pivots)), sketch[pivots])
        out.append(pivots[inside])
        if len(rows) <= PIVOTS:
            break
        links, rest = part_from_pivots(sketch[rows])
        out.append(rows[links])
        rows = rows[rest]
    return np.concatenate(out)


def _likely_links(classes: DataFrame) -> DataFrame:
    """(u, v) keys of classes that a tree node holds to be alike; at most one row for each row of a node."""
    rows = classes.select(F.explode("nodes").alias("node"), "key", "sketch")
    rows = rows.repartition("node").sortWithinPartitions("node", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, key, sketch = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, SKETCH), np.uint8)
        limit = 4096

        def out(pairs: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(key[pairs[:, 0]]), pa.array(key[pairs[:, 1]])], ["u", "v"])

        def settle(upto: int) -> Iterator[pa.RecordBatch]:
            """Links of the whole nodes in the first ``upto`` rows."""
            starts = np.flatnonzero(np.append(True, node[1:upto] != node[: upto - 1]))
            sizes = np.diff(np.append(starts, upto))
            small = np.repeat(sizes <= PIVOTS, sizes)
            places = np.flatnonzero(small)
            yield from out(places[small_node_links(node[places], sketch[places])])
            for start, size in zip(starts[sizes > PIVOTS], sizes[sizes > PIVOTS], strict=True):
                yield from out(start + large_node_links(sketch[start : start + size]))

        for batch in batches:
            node = np.append(node, batch.column(0).to_numpy())
            key = np.append(key, batch.column(1).to_numpy())
            new = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, SKETCH)
            sketch = np.concatenate([sketch, new])
            last = int(np.searchsorted(node, node[-1])) if len(node) else 0
            if last:
                yield from settle(last)
                node, key, sketch = node[last:], key[last:], sketch[last:]
            if len(node) > limit:  # a very large node: only pivots and rows that match none stay
                links, rest = part_from_pivots(sketch)
                yield from out(links)
                stay = np.append(np.arange(PIVOTS), rest)
                node, key, sketch = node[stay], key[stay], sketch[stay]
                limit = max(limit, 2 * len(node))
        if len(node):
            yield from settle(len(node))

    return rows.mapInArrow(run, "u long, v long")


# --- pass 3: confirmed links inside groups -------------------------------------------------------------


class Block:
    """Sets that others are compared with; what a set shares with all of them is counted at once."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        both = np.concatenate(sets)
        order = np.argsort(both, kind="stable")
        self.shingles = both[order]
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)[order]

    def linked(self, found: np.ndarray, percent: int) -> np.ndarray:
        """Places of the sets that share ``percent`` of the union with ``found``."""
        start, end = (np.searchsorted(self.shingles, found, side) for side in ("left", "right"))
        times = end - start
        at = np.repeat(start - np.cumsum(times) + times, times) + np.arange(times.sum())
        common = np.bincount(self.owner[at], minlength=len(self.sizes))
        return np.flatnonzero(100 * common >= percent * (self.sizes + len(found) - common))


class Settling:
    """Confirmed links of one place: a spanning forest of all pairs, whatever their order.

    Rows are taken block by block; a block is compared with itself and with every later row, also with those
    that are linked already, unless row and block are one component. A place beyond ``bounds`` (rows, shingles)
    is only compared with its first block here; its other rows are given back in ``rest``.
    """

    def __init__(self, percent: int, most: int, bounds: tuple[float, float] = (math.inf, math.inf)):
        self.percent, self.most, self.bounds = percent, most, bounds
        self.rows: list[tuple[int, np.ndarray]] = []
        self.size = 0
        self.union = Union()
        self.links: list[tuple[int, int]] = []
        self.first: tuple[list[int], Block] | None = None
        self.rest: list[tuple[int, int]] = []

    def add(self, key: int, found: np.ndarray, component: int | None = None) -> None:
        if component is not None:
            self.union.join(component, key)
        if self.first:
            self._meet_first(key, found)
            return
        self.rows.append((key, found))
        self.size += len(found)
        if len(self.rows) > self.bounds[0] or self.size > self.bounds[1]:
            upto = self._block_end(0)
            if upto < len(self.rows):
                rows, self.rows = self.rows, self.rows[:upto]
                self._settle(0, upto)
                self.first = [key for key, _ in self.rows], Block([found for _, found in self.rows])
                self.rows = []
                for row in rows[upto:]:
                    self._meet_first(*row)

    def _meet_first(self, key: int, found: np.ndarray) -> None:
        """Links of a row to the first block; the row itself is not kept."""
        keys, block = self.first
        met = {self.union.root(keys[j]): keys[j] for j in block.linked(found, self.percent)}
        self.links += [(key, other) for other in met.values()]
        for other in met:
            self.union.join(next(iter(met)), other)
        self.rest.append((key, len(found)))

    def _link(self, a: int, b: int) -> None:
        if self.union.join(a, b):
            self.links.append((b, a))

    def _block_end(self, at: int) -> int:
        upto, size = at, 0
        while upto < len(self.rows) and upto - at < self.most and (upto == at or size + len(self.rows[upto][1]) <= TOGETHER_SIZE):
            size += len(self.rows[upto][1])
            upto += 1
        return upto

    def _settle(self, at: int, upto: int) -> None:
        """Compares the block from ``at`` to ``upto`` with itself and all later rows."""
        root = self.union.root
        keys = [key for key, _ in self.rows[at:upto]]
        block = Block([found for _, found in self.rows[at:upto]])
        for i in range(at + 1, len(self.rows)):
            key, found = self.rows[i]
            mine, others = root(key), keys[: i - at]
            if any(root(other) != mine for other in others):
                for j in block.linked(found, self.percent):
                    if j < len(others):
                        self._link(others[j], key)

    def finish(self) -> list[tuple[int, int]]:
        at = 0
        while len(self.rows) - at > 1:
            upto = self._block_end(at)
            self._settle(at, upto)
            at = upto
            if len({self.union.root(key) for key, _ in self.rows}) == 1:
                break
        return self.links


def _places(rows: DataFrame, words: int, depth: int, trees: int) -> DataFrame:
    """(place, key, text) for rows (key, component, large, text): the group, or the nodes of a large one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, component, large, text = (batch.column(i) for i in range(4))
            large = large.to_numpy(zero_copy_only=False)
            row, place = np.flatnonzero(~large), component.to_numpy()[~large]
            for i in np.flatnonzero(large):
                values = minwise(shingles(text[i].as_py(), words))
                nodes = np.unique(leaf_nodes(values[None, :], depth, trees)[1])
                nodes = mix(nodes ^ U(component[i].as_py() & (2**64 - 1))).view(np.int64)
                row, place = np.append(row, np.full(len(nodes), i)), np.append(place, nodes)
            for at in range(0, len(row), 500):
                some = pa.array(row[at : at + 500])
                yield pa.RecordBatch.from_arrays([pa.array(place[at : at + 500]), key.take(some), text.take(some)], ["place", "key", "text"])

    return rows.select("key", "component", "large", "text").mapInArrow(run, "place long, key long, text string")


def _settled(rows: DataFrame, words: int, percent: int, bounds: tuple[float, float]) -> DataFrame:
    """(place, u, v, n) for rows (place, key, text, component): links of the rows of each place.

    In places beyond the bounds, rows outside the first block come as u with n shingles, and without v.
    """
    rows = rows.repartition("place").sortWithinPartitions("place", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seen, group = None, None, Settling(percent, TOGETHER, bounds)

        def out(found: list[tuple[int | None, ...]]) -> Iterator[pa.RecordBatch]:
            if found:
                columns = [pa.array(x, pa.int64()) for x in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([at] * len(found), pa.int64()), *columns], ["place", "u", "v", "n"])

        def taken(some: int) -> Iterator[pa.RecordBatch]:
            """What the group gives so far, if it is more than ``some`` rows."""
            if len(group.links) + len(group.rest) > some:
                yield from out([*((u, v, None) for u, v in group.links), *((u, None, n) for u, n in group.rest)])
                group.links, group.rest = [], []

        for batch in batches:
            for place, key, text, component in zip(*(batch.column(i) for i in range(4)), strict=True):
                place, key = place.as_py(), key.as_py()
                if place != at:
                    group.finish()
                    yield from taken(0)
                    at, seen, group = place, None, Settling(percent, TOGETHER, bounds)
                if key == seen:
                    continue  # a repeated row
                found = shingles(text.as_py(), words)
                if key_of(class_of(found)) != key:
                    continue  # another text under the same id
                seen = key
                group.add(key, found, component.as_py())
                yield from taken(4096)
        group.finish()
        yield from taken(0)

    return rows.select("place", "key", "text", "component").mapInArrow(run, "place long, u long, v long, n long")


def _units(rest: DataFrame, found: DataFrame) -> DataFrame:
    """(unit, place, key, component) for rows (place, key, n) whose pairs are open, and components so far.

    Rows of a place are dealt into chunks, a large component into chunks of its own. A unit is a chunk or two;
    every two rows of a place meet in one, unless they are known to be connected.
    """
    label = found.select(F.col("u").alias("key"), "component")
    rows = rest.join(label, "key", "left").select("place", "key", "n", F.coalesce("component", "key").alias("component"))
    parts = rows.groupBy("place", "component").agg(F.count("*").alias("m"), F.sum("n").alias("n"))
    several = parts.groupBy("place").agg(F.count("*").alias("components")).where("components > 1").select("place")
    load = F.greatest(F.col("m") / CHUNK, F.col("n") / CHUNK_SIZE)
    parts = parts.join(several, "place").withColumn("owner", F.when(load > 0.5, F.col("component")))
    chunks = parts.groupBy("place", "owner").agg(F.sum("m").alias("m"), F.sum("n").alias("n"))
    chunks = chunks.select("place", "owner", F.ceil(load).cast("int").alias("count"))
    owner = parts.select("place", "component", "owner")
    rows = rows.join(owner, ["place", "component"])
    sized = chunks.select(F.col("place").alias("p"), F.col("owner").alias("o"), "count")
    rows = rows.join(sized, (rows["place"] == sized["p"]) & rows["owner"].eqNullSafe(sized["o"]))
    rows = rows.withColumn("no", F.pmod(F.xxhash64("key"), F.col("count"))).select("place", "key", "component", "owner", "no")
    rows = stage_table(rows, "open")
    chunk = rows.select("place", "owner", "no").distinct().select("place", F.struct("owner", "no").alias("a"))
    pairs = chunk.join(chunk.withColumnRenamed("a", "b"), "place").where("a <= b")
    pairs = pairs.where("a.owner is null or b.owner is null or a.owner <> b.owner")
    pairs = pairs.withColumn("unit", F.xxhash64("place", "a", "b"))
    sides = pairs.select("place", "unit", F.explode(F.array_distinct(F.array("a", "b"))).alias("c"))
    sides = sides.select(F.col("place").alias("p"), "unit", F.col("c.owner").alias("o"), F.col("c.no").alias("c"))
    same = (rows["place"] == sides["p"]) & rows["owner"].eqNullSafe(sides["o"]) & (rows["no"] == sides["c"])
    return rows.join(sides, same).select("unit", "place", "key", "component")


def _confirmed_links(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """(u, v) for rows (place, key, text); rows of a place are compared with each other.

    A place within the bounds is settled by one task. Of a larger one, a task compares the first block with all
    rows; the pairs that leaves open, if any, are dealt to units of bounded size and settled there.
    """
    none = F.lit(None).cast("long").alias("component")
    found = stage_table(_settled(rows.select("place", "key", "text", none), words, percent, (CHUNK, CHUNK_SIZE)), "links")
    links = found.where("v is not null").select("u", "v")
    rest = found.where("v is null").select("place", F.col("u").alias("key"), "n")
    if rest.isEmpty():
        return links
    units = stage_table(_units(rest, components(links)), "units")
    if units.isEmpty():
        return links
    of = units.select("unit", F.col("place").alias("p"), F.col("key").alias("k"), "component")
    again = rows.join(of, (rows["place"] == of["p"]) & (rows["key"] == of["k"]))
    again = again.select(F.col("unit").alias("place"), "key", "text", "component")
    more = _settled(again, words, percent, (math.inf, math.inf))
    return links.unionByName(more.select("u", "v"))


def key_of(cls: bytes) -> int:
    return int.from_bytes(cls[:8], "big", signed=True)


def _key() -> Column:
    """The first 8 bytes of a class hash; candidates only, links are confirmed on sets."""
    return F.conv(F.hex(F.substring("cls", 1, 8)), 16, -10).cast("long").alias("key")


# --- the whole join ------------------------------------------------------------------------------------


def _grouped(docs: DataFrame, words: int, percent: int, recall: float = RECALL) -> DataFrame:
    """doc_id, digest of the text, n, component (key of a class), component_id: one row for each row of ``docs``."""
    spark: SparkSession = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    depth, trees = forest_size(docs.count(), recall, percent)
    sets = stage_table(_sets(docs, words, depth, trees), "sets")
    classes = sets.where("n > 0").groupBy("cls").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("nodes").alias("nodes")
    )
    classes = stage_table(classes.select(_key(), "*"), "classes")

    groups = stage_table(components(_likely_links(classes)), "groups")
    narrow = classes.select("key", "doc_id", "n")
    members = narrow.join(groups, narrow["key"] == groups["u"]).select("key", "doc_id", "n", "component")
    sizes = members.groupBy("component").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    large = (F.col("members") > TOGETHER) | (F.col("shingles") > TOGETHER_SIZE)
    members = stage_table(members.join(sizes, "component").select("key", "doc_id", "component", large.alias("large")), "members")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text_of().alias("text"))
    # shuffled at every size: the members are a share of the table
    rows = texts.join(members.hint("shuffle_hash"), texts["id"].eqNullSafe(members["doc_id"]))
    rows = _places(rows, words, depth, trees)
    links = components(_confirmed_links(rows, words, percent))

    labels = classes.select("cls", "key", "doc_id").join(links, classes["key"] == links["u"], "left")
    labels = labels.select("cls", F.coalesce("component", "key").alias("component"), "doc_id")
    least = labels.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    labels = labels.join(least, "component").select("cls", "component", "component_id")
    cls = F.when(F.col("n") > 0, F.col("cls")).alias("cls")
    return sets.select("doc_id", "digest", "n", cls).join(labels, "cls", "left").drop("cls")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = PERCENT, recall: float = RECALL) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs``."""
    found, empty = _grouped(docs, words, percent, recall), F.col("n") == 0
    component = F.when(empty, F.col("doc_id")).otherwise(F.col("component_id"))
    kept = F.coalesce(F.col("doc_id") == component, component.isNull())
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"))


def deduplicated(docs: DataFrame, words: int = 5, percent: int = PERCENT) -> DataFrame:
    """One document of each group: the smallest id, rows without id last, then the smallest digest of the text.

    Rows that repeat id and text count once. Rows are told by id and text, as ids may be null or repeated.
    """
    found = _grouped(docs, words, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("first")
    kept = found.where("n > 0").groupBy("component").agg(first).select("first.doc_id", "first.digest")
    kept = kept.unionByName(found.where("n = 0").select("doc_id", "digest").distinct())
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("digest").alias("kept_digest"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("kept_id")) & (_digest() == F.col("kept_digest"))
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])


def op9_near_dup(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, words=2)
