"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of shuffled documents, repeated up to ``repeat`` times. A document's virtual
finish time is its source's cumulative word count divided by the source's target. Targets add up to the
budget, so serving documents in the order of virtual time spends the budget exactly at time 1; there the
queue is cut, and a document that is being served is cut to the words served so far.

The cumulative counts are a two-level prefix sum (source and hash bucket, then inside a bucket), so a
source with a third of all rows is spread over all tasks. Only per-bucket sums are ever gathered.

Defined results: null or empty text has size 0 and takes 0; a null source is a source of its own, last in
the order of sources; repeated rows are separate documents; an empty table gives an empty result; input
columns travel in a struct, so their names cannot clash with the added ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from safetylake.llm.common import WORD, boxed, text_of

BUCKET_DIGITS = 3  # 16 ** 3 buckets a source


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, repeat: int = 2
) -> DataFrame:
    """Targets by water filling over ``sizes`` (queue, source, source_size), one row per source.

    A target never exceeds ``repeat`` times its source's size; the excess goes to the other sources by
    weight. With sources sorted by cap / weight, the water level is where the caps below it and the
    weights above it use up the budget.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    by_fill = Window.orderBy("fill", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    level = level / F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    return (
        sizes.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(repeat)))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("fill", F.col("cap") / F.col("weight"))
        .withColumn("level", level)
        .withColumn("level", F.max(F.when(F.col("fill") > F.col("level"), F.col("level"))).over(everything))
        .withColumn("target", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))))
        .select("queue", "source_size", "target")
    )


def _served(start: Column, size: Column, target: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), F.least(size, F.floor(target) - start))


def schedule(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    repeat: int = 2,
    seed: str = "mix",
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """One row per document: row (struct), size, source_size, target, start, served (words per pass).

    The struct holds the input's columns, or only those named in ``carry``; the rest is not shuffled.
    """
    kept = F.struct(*[F.col(f"row.`{c}`").alias(c) for c in (docs.columns if carry is None else carry)])
    shuffled = (
        boxed(docs)
        .withColumn("size", F.regexp_count(text_of("row.text"), F.lit(WORD)).cast("long"))
        .withColumn("tie", F.xxhash64("row.text"))
        .withColumn("queue", F.coalesce(F.concat(F.lit("="), F.col("row.source")), F.lit("")))
        .withColumn("place", F.md5(F.concat_ws(":", F.lit(seed), F.col("row.doc_id").cast("string"))))
        .withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
        .withColumn("source", F.col("row.source"))
        .withColumn("row", kept)
    )
    buckets = shuffled.groupBy("queue", "bucket").agg(
        F.first("source").alias("source"), F.sum("size").alias("bucket_size")
    )
    sizes = buckets.groupBy("queue").agg(F.first("source").alias("source"), F.sum("bucket_size").alias("source_size"))
    before = F.sum("bucket_size").over(Window.partitionBy("queue").orderBy("bucket")) - F.col("bucket_size")
    buckets = buckets.withColumn("before", before).drop("source", "bucket_size")
    buckets = buckets.join(source_targets(sizes, weights, share, repeat), "queue")
    inside = (
        Window.partitionBy("queue", "bucket")
        .orderBy("place", "size", "tie")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    start = F.col("before") + F.sum("size").over(inside) - F.col("size")
    passes = [
        _served(F.col("start") + F.lit(p) * F.col("source_size"), F.col("size"), F.col("target")) for p in range(repeat)
    ]
    return (
        shuffled.drop("source").join(buckets, ["queue", "bucket"])
        .withColumn("start", start)
        .withColumn("served", F.array(*passes))
        .select("row", "size", "source_size", "target", "start", "served")
    )


def in_virtual_order(scheduled: DataFrame) -> DataFrame:
    """Globally range-sorted by the virtual time at which a document's first pass ends."""
    finish = F.coalesce((F.col("start") + F.col("size")) / F.col("target"), F.lit(0.0))
    return scheduled.withColumn("finish", finish).repartitionByRange("finish").sortWithinPartitions("finish")


def first_words(text: Column, words: Column) -> Column:
    """The text up to the end of its word number ``words``."""
    pieces = F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    return F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), "")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: one row per copy, in virtual order, with the columns of ``docs``.

    A copy cut by the end of the budget keeps the text of its served words; ``n_chars`` follows the text.
    """
    copies = (
        schedule(docs, **options)
        .select("*", F.posexplode("served").alias("pass", "words"))
        .where("words > 0")
        .withColumn("finish", (F.col("start") + F.col("pass") * F.col("source_size") + F.col("size")) / F.col("target"))
        .repartitionByRange("finish")
        .sortWithinPartitions("finish")
    )
    whole = F.col("words") == F.col("size")
    text = F.when(whole, F.col("row.text")).otherwise(first_words(F.col("row.text"), F.col("words")))
    changed = {"text": text, "n_chars": F.when(whole, F.col("row.n_chars")).otherwise(F.length(text).cast("long"))}
    return copies.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op1_mixing(docs: DataFrame) -> DataFrame:
    served = F.aggregate("served", F.lit(0).cast("long"), lambda total, x: total + x)
    return in_virtual_order(schedule(docs, carry=["doc_id"])).select("row.doc_id", "size", "source_size", "target", served.alias("taken"))


#: DuckDB SQL for op1_mixing over ``documents``.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0 ELSE 2.0 END AS weight
  FROM d GROUP BY source),
f AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM s),
l AS (
  SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM f),
t AS (
  SELECT source, source_size, least(cap, coalesce(max(CASE WHEN cap / weight > lev THEN lev END) OVER () * weight, cap)) AS target FROM l),
c AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.size ROWS UNBOUNDED PRECEDING) - d.size AS BIGINT) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, floor(target) - start)) + greatest(0, least(size, floor(target) - source_size - start)) AS BIGINT) AS taken
FROM c
"""
