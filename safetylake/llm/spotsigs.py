"""Document fingerprints by SpotSigs, in DataFrame functions only.

A common word (of up to three letters, or one of a fixed list) is an anchor; an anchor and the two content
words that follow it make a signature, whatever common words stand between. The set of signature hashes is
the fingerprint, at every length of text; only a text without any signature gets the hash of its whole word
sequence instead.

Two fingerprints are compared by the Jaccard measure of their sets. For a join, sets are partitioned by
length: sets that share a part ``t`` of their union have lengths within a factor t, so a band of lengths
meets itself and the next one only; inside, a set goes by its rarest signatures, as many as any partner must
share one of, and pairs whose lengths already rule them out are pruned before sets are compared.

Defined results: null and empty texts, and texts without letters and digits, have the empty fingerprint;
two empty fingerprints are alike (1.0), an empty and another are not (0.0); rows that share a doc_id are one
place in the order of documents, represented by the smallest text; a null doc_id comes last; the document
after the last is the first, so a single document is its own next one; an empty table gives no rows; only
doc_id and text are read, so other columns of any name are left aside.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from safetylake.llm.common import text_of
from safetylake.session import stage_table

# Fixed list: common words of more than three letters in four languages.
COMMON = (
    "about also been from have into more only other some than that their them then there these they this were what "
    "when which will with would your dans pour avec cette mais sont plus elle nous vous leur comme nicht eine einen "
    "einer sich auch oder aber nach wird para como este esta pero sobre entre todo"
).split()


def with_signatures(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``rows`` with ``out``, the sorted set of signature hashes (array<int>) of column ``text``.

    The steps are columns of their own, so that each is computed once.
    """
    plain, words, steps, chains = (f"{out}_{n}" for n in ("plain", "words", "steps", "chains"))
    common = lambda w: (F.length(w) <= 3) | w.isin(COMMON)

    def step(before: Column, word: Column) -> Column:
        """A content word, with the common word right before it if there is one; null for a common word."""
        return F.when(~common(word), F.when(common(before), F.concat(before, F.lit(" "), word)).otherwise(word))

    def chain(a: Column, b: Column) -> Column:
        return F.when(b.isNotNull() & F.contains(a, F.lit(" ")), F.hash(a, F.substring_index(b, " ", -1)))

    def following(column: str) -> Column:
        return F.slice(column, F.lit(2), F.greatest(F.lit(1), F.size(column)))

    none = F.array().cast("array<int>")
    return (
        rows.withColumn(plain, F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")))
        # a long word of its own stands before the first one
        .withColumn(words, F.concat(F.array(F.lit("----")), F.split(plain, " ")))
        .withColumn(steps, F.array_compact(F.zip_with(words, following(words), lambda a, b: F.when(b.isNotNull(), step(a, b)))))
        .withColumn(chains, F.array_compact(F.zip_with(steps, following(steps), chain)))
        .withColumn(
            out,
            F.when(F.size(chains) > 0, F.array_sort(F.array_distinct(chains)))
            .when(F.col(plain) != "", F.array(F.hash(plain)))
            .otherwise(none),
        )
        .drop(plain, words, steps, chains)
    )


def fingerprint(sets: Column) -> Column:
    """Eight hexadecimal digits for each signature, in order; empty for the empty set."""
    digits = lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))), 8, "0")
    return F.array_join(F.transform(sets, lambda x: digits(x.cast("long"))), "")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard measure of two sets; with ``least``, sets whose lengths rule it out count 0 unseen."""
    shared = F.size(F.array_intersect(a, b))
    full = F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(shared / (F.size(a) + F.size(b) - shared))
    return F.when(F.least(F.size(a), F.size(b)) < least * F.greatest(F.size(a), F.size(b)), F.lit(0.0)).otherwise(full)


def next_ids(rows: DataFrame) -> DataFrame:
    """rows (distinct doc_id, ...) with ``next``, a struct of the next id in ascending order, the first after the last.

    Ids are range-partitioned; inside a range the next row is a window away, and only each range's first
    id is looked at across ranges.
    """
    order = F.col("doc_id").asc_nulls_last()
    ranged = stage_table(rows.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "ids")
    here = Window.partitionBy("part").orderBy(order)
    seen = ranged.withColumn("next", F.lead(F.struct("doc_id")).over(here)).withColumn("first", F.row_number().over(here) == 1)
    across = Window.orderBy("part")
    firsts = seen.where("first").select("part", F.struct("doc_id").alias("id"))
    wrap = F.first("id").over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = firsts.select("part", F.coalesce(F.lead("id").over(across), wrap).alias("after"))
    return seen.join(firsts, "part").withColumn("next", F.coalesce("next", "after")).drop("part", "first", "after")


def with_edited(docs: DataFrame) -> DataFrame:
    """doc_id, text, sets, edited, edited_sets, next_sets for every document.

    ``edited`` is the text whose last quarter of code points is replaced by the start of the next document.
    """
    base = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    quarter = F.floor(F.length("text") / 4).cast("int")
    links = next_ids(base.groupBy("doc_id").agg(F.max(quarter).alias("need")))
    links = links.select(F.col("doc_id").alias("of"), F.col("next.doc_id").alias("next_id"), "need")
    marked = with_signatures(base, "text", "sets")
    starts = marked.join(links.hint("merge"), marked["doc_id"].eqNullSafe(links["next_id"]))
    starts = starts.select("of", F.struct(F.substring("text", F.lit(1), F.col("need")).alias("start"), F.col("sets").alias("next_sets")).alias("n"))
    starts = starts.groupBy("of").agg(F.min("n").alias("n")).select("of", "n.start", "n.next_sets")
    joined = marked.join(starts.hint("merge"), marked["doc_id"].eqNullSafe(starts["of"]))
    head = F.substring("text", F.lit(1), F.length("text") - quarter)
    edited = F.concat(head, F.substring("start", F.lit(1), quarter))
    return with_signatures(joined.withColumn("edited", edited), "edited", "edited_sets").drop("of", "start")


def near_pairs(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(a, b, score): pairs of fingerprints with a likeness of ``least`` or more, a before b.

    Documents with equal fingerprints are one class under its smallest doc_id; pairs are between classes.
    """
    marked = with_signatures(docs.select(F.col("doc_id").cast("long"), text_of().alias("text")), "text", "sets")
    marked = marked.where(F.size("sets") > 0)
    classes = stage_table(marked.groupBy("sets").agg(F.min("doc_id").alias("id")), "prints")
    band = F.floor(F.log(F.size("sets").cast("double")) / -math.log(least)).cast("int")
    rarity = classes.select(F.explode("sets").alias("sig")).groupBy("sig").agg(F.count("*").alias("df"))
    spread = classes.select("id", F.explode("sets").alias("sig")).join(rarity, "sig")
    place = F.row_number().over(Window.partitionBy("id").orderBy("df", "sig"))
    sizes = classes.select("id", band.alias("band"), F.size("sets").alias("n"))
    prefix = spread.withColumn("place", place).join(sizes, "id").where(F.col("place") <= F.col("n") - F.ceil(F.lit(least) * F.col("n")) + 1)
    here = prefix.select("sig", "band", "id", "n")
    there = here.select("sig", F.explode(F.array("band", F.col("band") + 1)).alias("band"), F.col("id").alias("other"), F.col("n").alias("m"))
    met = here.join(there, ["sig", "band"]).where((F.col("id") != F.col("other")) & (F.least("n", "m") >= F.lit(least) * F.greatest("n", "m")))
    pairs = met.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
    left = classes.select(F.col("id").alias("a"), F.col("sets").alias("x"))
    right = classes.select(F.col("id").alias("b"), F.col("sets").alias("y"))
    scored = pairs.join(left, "a").join(right, "b").withColumn("score", likeness(F.col("x"), F.col("y"), least))
    return scored.where(F.col("score") >= least).select("a", "b", "score")


def op5_spotsigs(docs: DataFrame) -> DataFrame:
    return with_edited(docs).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        fingerprint(F.col("sets")).alias("fingerprint"), fingerprint(F.col("edited_sets")).alias("edited_fingerprint"),
        likeness(F.col("sets"), F.col("edited_sets")).alias("near_edited"),
        likeness(F.col("sets"), F.col("next_sets")).alias("near_next"),
    )
