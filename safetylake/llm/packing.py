"""Packing documents into training windows by Karmarkar-Karp multiway differencing.

A document is its token ids and one end id. Whole windows are cut from the front of a long document; the
rest is cut into parts of at most ``part`` ids. Parts are gathered per task until they fill ``group``
windows; multiway differencing then spreads them (a group is closed where its ids fall a little short of whole windows, so that
few of its places stay empty): every part starts as a partial partition, and the two
partial partitions with the largest imbalance are merged, the fullest window of one with the emptiest of
the other. If a window exceeds the capacity the window count rises and the group is dealt again.

A task reads its rows once and holds one batch of rows and one group; nothing is shuffled, so hot sources
and repeated rows do not matter. Window ids hold the number of the input partition, so a lost task repeats
its windows when it runs again.

Defined results: null and empty texts are the end id alone; repeated rows and ids are separate documents; a
null doc_id stays null; an empty table gives no rows; only doc_id and text are read, so other columns of any
name are left aside.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safetylake.llm.common import text_of

WINDOW = 1024
PART = 256
GROUP = 64  # windows dealt at once
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


@lru_cache(maxsize=2)
def encoder(path: str):
    """Text to token ids with the vocabulary file ``path`` of the ``tokenizers`` library.

    The file's merges are in the order of its ids, so its ids serve as merge ranks. The faster encoder
    gives the same ids (tests compare them); texts that it cannot take go to the library itself.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    special = {x["content"]: x["id"] for x in model["added_tokens"]}  # found in texts as the library finds them
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
    fast = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    exact = Tokenizer.from_file(path)

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            return np.array(exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    return encode


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Deals item numbers to at most ``k`` windows; a partial partition lists its windows, fullest first."""
    heap = [(-size, i, [(size, [i])]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    mark = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        over = len(a) + len(b) - k
        if over <= 0:
            merged = a + b
        else:  # the last ``over`` windows of a meet the last of b, emptiest with fullest
            both = zip(a[len(a) - over :], reversed(b[len(b) - over :]), strict=True)
            merged = [*a[: len(a) - over], *b[: len(b) - over], *((s + t, x + y) for (s, x), (t, y) in both)]
        merged.sort(key=lambda w: -w[0])
        least = merged[-1][0] if len(merged) == k else 0
        heapq.heappush(heap, (least - merged[0][0], mark, merged))
        mark += 1
    return [items for _, items in heap[0][2]] if heap else []


def deal(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows within the capacity; the count rises until none exceeds it."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        windows = differencing(sizes, k)
        if all(sum(sizes[i] for i in w) <= capacity for w in windows):
            return windows
        k += max(1, k // 100)


def pieces(rows: Iterable[tuple[int | None, np.ndarray]], first_id: int, window: int, part: int, group: int) -> Iterator[tuple]:
    """Rows of PIECES for (doc_id, ids) rows, in bounded memory."""
    sequence = first_id
    waiting: list[tuple] = []
    held = 0

    def flush() -> Iterator[tuple]:
        nonlocal sequence
        for items in deal([len(x[2]) for x in waiting], window):
            offset = 0
            for i in items:
                doc_id, start, ids, total = waiting[i]
                yield doc_id, start, len(ids), ids.tobytes(), total, sequence, offset
                offset += len(ids)
            sequence += 1

    for doc_id, ids in rows:
        total = len(ids)
        whole = total - total % window
        for start in range(0, whole, window):
            yield doc_id, start, window, ids[start : start + window].tobytes(), total, sequence, 0
            sequence += 1
        rest = total - whole
        if rest:
            cuts = np.linspace(whole, total, -(-rest // part) + 1).astype(int)
            waiting += [(doc_id, int(s), ids[s:e], total) for s, e in zip(cuts, cuts[1:], strict=False)]
            held += rest
        slack = -held % window
        if held >= group * window and (2 * group <= slack <= window // 3 or held >= 2 * group * window):
            yield from flush()
            waiting, held = [], 0
    if waiting:
        yield from flush()


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    window: int = WINDOW,
    part: int = PART,
    group: int = GROUP,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of documents with their token ids (little-endian unsigned 32-bit) and their place."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    names = [x.split(" ")[0] for x in PIECES.split(", ")]
    types = [pa.binary() if n == "ids" else pa.int64() for n in names]

    def ids_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        encode = encoder(path)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py())
                yield doc_id, np.append(ids, end_id).astype("<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        out: list[tuple] = []
        for piece in pieces(ids_of(batches), context.partitionId() << 33, window, part, group):
            out.append(piece)
            if len(out) >= 4096:
                yield to_batch(out)
                out = []
        if out:
            yield to_batch(out)

    def to_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, PIECES)


def op3_packing(docs: DataFrame) -> DataFrame:
    return pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
