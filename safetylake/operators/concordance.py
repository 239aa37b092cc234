"""Set-based agreement between two frames of case values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from safetylake.functions import text
from safetylake.functions.measures import age_match, f1_columns, ratio
from safetylake.operators.truth import one_per_case
from safetylake.session import stage_table


def coding_concordance(predicted: DataFrame, gold: DataFrame, key: str = "vaers_id") -> DataFrame:
    """Precision, recall and F1 of two (key, term) frames, compared as sets per key.

    Terms are normalised; NULL and empty terms are ignored. Both sides are reduced to
    distinct (key, term) rows in the one aggregation that also matches them, so a key may
    hold any number of rows. A key whose terms are all ignored is reported with zero counts.
    """

    def side(df: DataFrame, p: int, g: int) -> DataFrame:
        term = F.when(F.length("term") > 0, text.normalize_pt(F.col("term")))
        return df.select(key, term.alias("term"), F.lit(p).alias("p"), F.lit(g).alias("g"))

    terms = (
        side(predicted, 1, 0)
        .unionAll(side(gold, 0, 1))
        .groupBy(key, "term")
        .agg(F.max("p").alias("p"), F.max("g").alias("g"))
    )
    real = F.col("term").isNotNull()

    def tally(p: int, g: int):
        return F.count_if(real & (F.col("p") == p) & (F.col("g") == g))

    counts = terms.groupBy(key).agg(
        tally(1, 1).alias("tp"), tally(1, 0).alias("fp"), tally(0, 1).alias("fn")
    )
    metrics = f1_columns(F.col("tp"), F.col("fp"), F.col("fn"))
    return counts.select(key, "tp", "fp", "fn", *[c.alias(n) for n, c in metrics.items()])


def demographic_concordance(
    extracted: DataFrame, truth: DataFrame, tolerance: float = 1.0
) -> DataFrame:
    """Sex and age agreement per case: (vaers_id, sex, age_years) against (vaers_id, sex, age_yrs).

    sex_match is never NULL; age_match is NULL when either age is unknown. The truth counts once
    per case (its newest load) however often its report was loaded, so the join stays linear.
    """
    x = extracted.select(
        "vaers_id",
        text.normalize_sex(F.col("sex")).alias("x_sex"),
        F.col("age_years").alias("x_age"),
    )
    known = truth.withColumn("gt_sex", text.normalize_sex(F.col("sex"))).withColumn("gt_age", F.col("age_yrs"))
    g = one_per_case(known, "gt_sex", "gt_age")
    return (
        x.join(g, "vaers_id")
        .withColumn("sex_match", F.col("x_sex") == F.col("gt_sex"))
        .withColumn("age_match", age_match(F.col("x_age"), F.col("gt_age"), tolerance))
    )


GRAM = 3


def contained_names(names: DataFrame) -> DataFrame:
    """(name, part): every listed name that is a substring of a listed name, itself included.

    A name's rarest run of ``GRAM`` characters occurs in every name that holds it: names meet by an
    equi-join on that run and are then compared. A name gives as many rows as it has characters, and
    common runs ("COV") bring no names together. Names shorter than a run are matched as they are.
    """
    listed = stage_table(names.distinct(), "names")  # few beside the cases, and read several times
    size = F.length("name")
    sizes = F.array(*[F.lit(n) for n in range(1, GRAM + 1)])
    # runs of 1 to GRAM characters: one row per start and length, never an array of substrings
    starts = listed.where(size > 0).select("name", F.explode(F.sequence(F.lit(1), size)).alias("start"))
    cut = starts.select("name", "start", F.explode(sizes).alias("n")).where(F.col("start") + F.col("n") - 1 <= size)
    runs = cut.select("name", "n", F.substring("name", F.col("start"), F.col("n")).alias("run")).distinct()
    runs = stage_table(runs, "name-runs")
    long = runs.where(F.col("n") == GRAM).select("name", "run")
    often = long.groupBy("run").agg(F.count(F.lit(1)).alias("names"))
    rarest = long.join(often, "run").groupBy("name").agg(F.min(F.struct("names", "run"))["run"].alias("run"))
    keys = rarest.unionAll(listed.where((size > 0) & (size < GRAM)).select("name", F.col("name").alias("run")))
    found = runs.select("name", "run").join(keys.withColumnRenamed("name", "part"), "run")
    # the empty name, where it is listed, is inside every name
    in_all = listed.withColumn("part", F.lit("")).join(listed.withColumnRenamed("name", "part"), "part", "left_semi")
    return found.where(F.contains("name", F.col("part"))).select("name", "part").unionAll(in_all.select("name", "part"))


def product_concordance(
    extracted: DataFrame, truth: DataFrame, key: str = "vaers_id"
) -> DataFrame:
    """Share of true products found per case: (key, product) frames, loose name match.

    A true product is found when its normalised name equals, contains or is contained in some
    extracted one; NULL and '' names are ignored, a name without letters or digits matches
    anything. Recall is per listed name, repeats included, and NULL without a true product.
    """

    def side(df: DataFrame) -> DataFrame:
        name = F.when(F.length("product") > 0, text.normalize_product(F.col("product")))
        return df.select(key, name.alias("name"))

    found = side(extracted).filter("name is not null").distinct()
    wanted = side(truth).groupBy(key, "name").agg(F.count("name").alias("n"))
    listed = wanted.select("name").filter("name is not null").unionAll(found.select("name"))
    # Names repeat over cases; their relation is small, written once and read by both sides.
    parts = stage_table(contained_names(listed), "contained-names")
    inside_found = found.join(parts, "name").select(key, F.col("part").alias("name"))
    around_found = (
        wanted.join(parts, "name")
        .join(found.select(key, F.col("name").alias("part")), [key, "part"], "left_semi")
        .select(key, "name")
    )
    hits = inside_found.unionAll(around_found).distinct().withColumn("hit", F.lit(1))
    return (
        wanted.join(hits, [key, "name"], "left")
        .groupBy(key)
        .agg(
            F.sum("n").alias("n_products"),
            F.sum(F.col("n") * F.coalesce("hit", F.lit(0))).alias("n_found"),
        )
        .withColumn("recall", ratio(F.col("n_found"), F.col("n_products")))
    )


def concordance_summary(scored: DataFrame, **shares: str) -> DataFrame:
    """One row over all cases: number of cases and the mean of each named column."""
    return scored.agg(
        F.count(F.lit(1)).alias("n_cases"),
        *[
            F.round(F.avg(F.col(column).cast("double")), 6).alias(name)
            for name, column in shares.items()
        ],
    )
