"""Spelling variants: words of a corpus grouped under the frequent word one edit away.

Two words at one edit agree before the edit and after it. The place of the edit, the length of their common
beginning, falls into one of ``PARTS`` intervals of the longer word; for each interval a word goes to the group
named by what stands before and after it, so two near words meet in exactly one group, as the words of that
length and one less which differ inside the interval only. A group that more than ``limit`` words share is dealt
anew by halves of its interval, as often as needed; at an interval of one place a group is as small as the
alphabet. So no frequent beginning or ending gathers in a task, and none is left out.

Inside a group the method is sorted-list dynamic programming: the differing parts are scanned in order, the
edit-matrix rows (three cells wide around the diagonal) of the beginning that a word shares with the one before
are reused, and when every cell of a row exceeds one edit, all words with that beginning are skipped.

Each word's form is its most frequent near word, if frequent enough; roots follow forms to the last by pointer
doubling, since every form is at least ``ratio`` times as frequent as its variant.

Defined results: null and empty texts have no words; a null doc_id counts as an empty one in the hash that picks
the code point to delete (only where ``noise`` asks for deletion); words of any length are read whole; repeated
rows count each; equal counts go to the smaller word in code-point order; an empty table gives no rows; only
doc_id and text are read, so other columns of any name are left aside.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safetylake.llm.common import text_of
from safetylake.session import stage_table

LETTERS = "A-Za-zÀ-ÿ"
LENGTH, COUNT, RATIO = 6, 5, 5
NOISE = 199
PARTS = 3  # intervals of the place of an edit
LIMIT = 256  # words of a group that are scanned together
GROUP = ["m", "lo", "hi", "key"]
LINKS = "word string, other string, other_n long"


def word_counts(docs: DataFrame, length: int = LENGTH, count: int = COUNT, noise: int | None = None) -> DataFrame:
    """word, n: the words of at least ``length`` code points that occur at least ``count`` times.

    With ``noise``, a run whose hash with the doc_id is divisible by it loses one code point first.
    """
    low = F.translate(text_of(), string.ascii_uppercase, string.ascii_lowercase)
    runs = F.regexp_extract_all(low, F.lit(f"[{LETTERS}]{{{length},}}"), F.lit(0))
    words = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("word"))
    if noise:
        h = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        place = (F.col("h") % F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), place), F.substring("word", place + 2, F.length("word")))
        words = words.withColumn("h", h).withColumn("word", F.when(F.col("h") % noise == 0, cut).otherwise(F.col("word")))
        words = words.where(F.length("word") >= length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= count)


def _lcp(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


def scan(parts: list[str]) -> Iterator[tuple[int, int]]:
    """(i, j), i < j, for all pairs of a sorted list of distinct strings that are exactly one edit apart."""
    shared = [0, *(_lcp(a, b) for a, b in zip(parts, parts[1:], strict=False))]  # with the string before
    n = len(parts)
    for i, q in enumerate(parts):
        size = len(q)
        # rows[d] holds the cells (d - 1, d, d + 1) of the row of a beginning of d characters; 2 stands for more
        rows = [(2, 0, 1 if size else 2)]
        j = i + 1
        while j < n:
            y = parts[j]
            depth = len(rows) - 1
            dead = False
            for d in range(depth + 1, len(y) + 1):
                before, at, after = rows[-1]
                c = y[d - 1]
                # the cells of columns d - 1, d and d + 1: deletion in q, match or replacement, insertion
                left = min(before + (d < 2 or d - 2 >= size or q[d - 2] != c), at + 1) if d - 1 <= size else 2
                mid = min(at + (d - 1 >= size or q[d - 1] != c), left + 1, after + 1) if d <= size else 2
                right = min(after + (d >= size or q[d] != c), mid + 1) if d + 1 <= size else 2
                row = (left if left < 2 else 2, mid if mid < 2 else 2, right if right < 2 else 2)
                if row == (2, 2, 2):
                    dead = True
                    break
                rows.append(row)
            diff = size - len(y)
            if not dead and -1 <= diff <= 1 and rows[-1][diff + 1] == 1:
                yield i, j
            j += 1
            while dead and j < n and shared[j] >= d:  # whatever shares the row that ruled y out
                j += 1
            if j < n:
                del rows[min(shared[j], len(rows) - 1) + 1 :]


def group_links(m: int, lo: int, key: str, wild: list[str]) -> Iterator[tuple[int, int]]:
    """Pairs of one group: ``wild`` are the sorted parts between key[:lo] and key[lo:] of words of m or m - 1 characters."""
    widest = m - len(key)
    tail = key[lo : lo + 1]
    for i, j in scan(wild):
        x, y = wild[i], wild[j]
        if len(x) < widest and len(y) < widest:
            continue  # both are one shorter: they meet in their own length
        short, long = (x, y) if len(x) < len(y) else (y, x)
        if len(short) < len(long) and tail == long[-1] and long.startswith(short):
            continue  # their common beginning reaches beyond this interval: they meet in a later one
        yield i, j


def _find_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scans sorted groups and gives the links of both ends."""
    names = [x.split(" ")[0] for x in LINKS.split(", ")]
    types = [pa.string(), pa.string(), pa.int64()]
    out: list[tuple] = []

    def packed() -> pa.RecordBatch:
        columns = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def close(group: tuple, wild: list[str], counts: list[int]) -> None:
        m, lo, _, key = group
        for i, j in group_links(m, lo, key, wild):
            a, b = key[:lo] + wild[i] + key[lo:], key[:lo] + wild[j] + key[lo:]
            out.append((a, b, counts[j]))
            out.append((b, a, counts[i]))

    current, wild, counts = None, [], []
    for batch in batches:
        for m, lo, hi, key, part, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            group = (m, lo, hi, key)
            if group != current:
                if len(wild) > 1:
                    close(current, wild, counts)
                current, wild, counts = group, [], []
            wild.append(part)
            counts.append(n)
        if len(out) >= 4096:
            yield packed()
            out = []
    if len(wild) > 1:
        close(current, wild, counts)
    if out:
        yield packed()


def _placed(words: DataFrame, intervals) -> DataFrame:
    """Rows of the groups of ``words`` (m, word, n) for the intervals lo to hi that ``intervals`` lists."""
    return (
        words.select("m", "word", "n", F.explode(intervals).alias("at"))
        .select("m", "at.lo", "at.hi", "word", "n")
        .withColumn("tail", F.length("word") - F.col("m") + F.col("hi"))  # where the part after the interval starts
        .select(
            "m", "lo", "hi",
            F.concat(F.substring("word", F.lit(1), F.col("lo")), F.substring("word", F.col("tail") + 1, F.length("word"))).alias("key"),
            F.substring("word", F.col("lo") + 1, F.col("tail") - F.col("lo")).alias("wild"), "n",
        )
    )


def _interval(lo, hi):
    return F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))


def near_words(words: DataFrame, limit: int = LIMIT, parts: int = PARTS) -> DataFrame:
    """word, other, other_n: every ordered pair of ``words`` (distinct word, n) that are exactly one edit apart."""
    m = F.col("m")
    sized = words.select(F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("m"), "word", "n")
    # an interval of no places (in words shorter than the number of parts) has no group
    intervals = F.array(*[_interval(F.floor(m * k / parts), F.floor(m * (k + 1) / parts)) for k in range(parts)])
    rows = _placed(sized, F.filter(intervals, lambda x: x["lo"] < x["hi"]))
    found = []
    while True:
        large = rows.where("hi - lo > 1").groupBy(GROUP).agg(F.count("*").alias("size")).where(F.col("size") > limit)
        large = stage_table(large.select(GROUP), "large")
        more = not large.isEmpty()
        small = rows.join(large, GROUP, "left_anti") if more else rows
        dealt = small.repartition(*GROUP).sortWithinPartitions(*GROUP, "wild")
        found.append(stage_table(dealt.select(*GROUP, "wild", "n").mapInArrow(_find_links, LINKS), "links"))
        if not more:
            break
        rest = rows.join(large, GROUP, "left_semi")
        word = F.concat(F.substring("key", F.lit(1), F.col("lo")), F.col("wild"), F.substring("key", F.col("lo") + 1, F.length("key")))
        middle = F.floor((F.col("lo") + F.col("hi")) / 2)
        halves = F.array(_interval(F.col("lo"), middle), _interval(middle, F.col("hi")))
        rest = rest.select("m", word.alias("word"), "n", halves.alias("halves"))
        rows = stage_table(_placed(rest, F.col("halves")), "halves")
    links = found[0]
    for more_links in found[1:]:
        links = links.unionByName(more_links)
    return links


def variant_forms(words: DataFrame, ratio: int = RATIO, limit: int = LIMIT) -> DataFrame:
    """word, n, n_near, form, form_n, root for every word of ``words`` (word, n), which is read several times."""
    best = F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other")))
    near = near_words(words, limit).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    frequent = -F.col("best.rank") >= F.lit(ratio) * F.col("n")
    known = (
        words.join(near, "word", "left")
        .select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(frequent, F.col("best.other")).alias("form"), F.when(frequent, -F.col("best.rank")).alias("form_n"),
        )
    )
    known = stage_table(known, "forms")
    up = known.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    ends = known.agg(F.min("n"), F.max("n")).first()
    steps, reach = 0, ends[0]  # a chain of forms has at most so many steps
    while reach and reach * ratio <= ends[1]:
        steps, reach = steps + 1, reach * ratio
    doubled = 1
    while doubled < steps:
        above = up.select(F.col("word").alias("at"), F.col("root").alias("above"))
        met = up.join(above, F.col("root") == F.col("at"), "left")
        up = stage_table(met.select("word", F.coalesce("above", "root").alias("root")), "roots")
        doubled *= 2
    return known.join(up, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11_spelling(docs: DataFrame) -> DataFrame:
    words = stage_table(word_counts(docs, noise=NOISE), "words")
    return variant_forms(words).select("word", "form", "root", "n", "n_near", "form_n")
