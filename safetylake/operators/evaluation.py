"""Agreement of processed cases with the human coders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from safetylake.functions import text
from safetylake.functions.measures import f1_columns, guarded_corr, share_true
from safetylake.operators.truth import gt_term, one_per_case

RUN = ["run_id", "vaers_id", "pipeline_version"]


def json_text(column: str, path: str) -> Column:
    """Scalar at a JSON path as text; NULL when absent."""
    return F.get_json_object(F.col(column), path)


def json_array_size(column: str, path: str) -> Column:
    """Number of elements of a JSON array; NULL when there is no array."""
    return F.json_array_length(F.get_json_object(F.col(column), path)).cast("long")


def _agent_terms(outputs: DataFrame) -> DataFrame:
    """(run, content, term, times listed); a run without terms keeps one row with a NULL term.

    Repeats of a term are counted inside the row. ``content`` tells output rows of one run id apart:
    equal rows (a run appended twice) are one, different ones are scored each. The output rows are dealt by case, once,
    and their terms listed there: so a term row, with its run's texts, is never shuffled.
    """
    normalised = F.transform(
        F.filter(F.coalesce("coded_pts", F.array().cast("array<string>")), lambda t: t.isNotNull()),
        text.term_key,
    )
    serious = F.lower(json_text("seriousness", "$.serious"))
    return (
        outputs.select(
            *RUN,
            F.xxhash64("coded_pts", "seriousness").alias("content"),
            F.when(serious == "true", F.lit(True))
            .when(serious == "false", F.lit(False))
            .alias("agent_serious"),
            normalised.alias("terms"),
        )
        .repartition("vaers_id")
        .withColumn("pt_term", F.explode_outer(F.array_distinct("terms")))
        .withColumn(
            "times",
            F.when(F.col("pt_term").isNull(), F.lit(0)).otherwise(
                F.size("terms") - F.size(F.array_remove("terms", F.col("pt_term")))
            ),
        )
        .drop("terms")
        .dropDuplicates([*RUN, "content", "pt_term"])
    )


def eval_case(outputs: DataFrame, long: DataFrame, truth: DataFrame) -> DataFrame:
    """Coding counts and seriousness agreement per output row, for cases that have human codes.

    tp and fp count every listed term, repeats included; fn counts distinct human terms the
    run did not list. Human terms are matched by an equi-join on (case, term); the term list
    of a case is never gathered into one row. Both sides are dealt by case, which serves all joins and counts that
    follow. Of a case loaded several times the newest truth counts.
    """
    # Rows without an id meet nothing in either join, and no term is NULL: so both joins read one shuffle.
    named = long.filter(F.col("vaers_id").isNotNull()).select("vaers_id", F.coalesce("pt_term", F.lit("\0")).alias("pt_term"))
    human = gt_term(named.repartition("vaers_id"))
    matched = (
        _agent_terms(outputs)
        .join(human.withColumn("hit", F.lit(True)), ["vaers_id", "pt_term"], "left")
        .groupBy(*RUN, "content")
        .agg(
            F.max("agent_serious").alias("agent_serious"),
            F.sum(F.when(F.col("hit"), F.col("times")).otherwise(0)).alias("tp"),
            F.sum(F.when(F.col("hit"), 0).otherwise(F.col("times"))).alias("fp"),
            F.count("hit").alias("found"),
        )
    )
    # One truth row per case, however often its report was loaded: the join stays linear.
    once = one_per_case(truth, "serious").withColumnRenamed("serious", "gt_serious")
    facts = human.groupBy("vaers_id").agg(F.count(F.lit(1)).alias("n_gt")).join(once, "vaers_id")
    counted = matched.join(facts, "vaers_id").withColumn("fn", F.col("n_gt") - F.col("found"))
    metrics = f1_columns(F.col("tp"), F.col("fp"), F.col("fn"))
    return counted.select(
        *RUN, "tp", "fp", "fn",
        *[c.alias(name) for name, c in metrics.items()],
        (F.col("agent_serious") == F.col("gt_serious")).alias("seriousness_match"),
        "agent_serious", "gt_serious",
    )


def eval_dashboard(evaluated: DataFrame) -> DataFrame:
    """Mean scores per pipeline version."""
    return evaluated.groupBy("pipeline_version").agg(
        F.count(F.lit(1)).alias("n_cases"),
        F.round(F.avg("precision"), 4).alias("mean_precision"),
        F.round(F.avg("recall"), 4).alias("mean_recall"),
        F.round(F.avg("f1"), 4).alias("mean_coding_f1"),
        F.round(share_true(F.col("seriousness_match")), 4).alias("seriousness_accuracy"),
    )


def of_version(df: DataFrame, version: str) -> DataFrame:
    return df.filter(F.col("pipeline_version") == version)


def coding_scorecard(evaluated: DataFrame, version: str) -> DataFrame:
    return eval_dashboard(of_version(evaluated, version)).select(
        "pipeline_version", "n_cases", "mean_precision", "mean_recall", "mean_coding_f1"
    )


def full_scorecard(evaluated: DataFrame, version: str) -> DataFrame:
    return eval_dashboard(of_version(evaluated, version)).select(
        "pipeline_version", "n_cases", "mean_coding_f1", "seriousness_accuracy"
    )


def worst_cases(evaluated: DataFrame, version: str, n: int = 20) -> DataFrame:
    """The ``n`` runs with the lowest F1, for error review."""
    return (
        of_version(evaluated, version)
        .orderBy(F.col("f1").asc_nulls_first(), "vaers_id", "run_id")
        .limit(n)
        .select("vaers_id", "tp", "fp", "fn", F.round("f1", 3).alias("f1"))
    )


def causality_distribution(outputs: DataFrame, version: str) -> DataFrame:
    """Number of runs per causality category (shown, not scored), most frequent first."""
    return (
        of_version(outputs, version)
        .filter(F.col("causality").isNotNull())
        .groupBy(json_text("causality", "$.category").alias("category"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), F.col("category").asc_nulls_first())
    )


def eval_extraction(extractions: DataFrame, truth: DataFrame) -> DataFrame:
    """Extracted demographics, onset and event count beside the report form."""
    x = extractions.select(
        "run_id",
        "vaers_id",
        F.lower(json_text("extracted", "$.patient.sex")).alias("x_sex"),
        json_text("extracted", "$.patient.age_years").try_cast("double").alias("x_age"),
        json_text("extracted", "$.onset_date").alias("x_onset"),
        json_array_size("extracted", "$.events").alias("x_n_events"),
    )
    g = one_per_case(truth, "sex", "age_yrs", "onset_date", "n_coded_pts").select(
        "vaers_id",
        F.when(F.col("sex") == "M", "male")
        .when(F.col("sex") == "F", "female")
        .otherwise("unknown")
        .alias("gt_sex"),
        F.col("age_yrs").alias("gt_age"),
        F.date_format("onset_date", "yyyy-MM-dd").alias("gt_onset"),
        F.col("n_coded_pts").alias("gt_n_pts"),
    )
    close = F.abs(F.col("x_age") - F.col("gt_age")) <= 1
    known_onset = F.col("x_onset").isNotNull()
    return (
        x.join(g, "vaers_id")
        .withColumn("sex_match", F.col("x_sex") == F.col("gt_sex"))
        .withColumn("age_match", F.coalesce(close, F.lit(False)))
        .withColumn("onset_match", known_onset & (F.col("x_onset") == F.col("gt_onset")))
    )


def extraction_scorecard(compared: DataFrame) -> DataFrame:
    """One row of extraction accuracies over all runs."""
    return compared.agg(
        F.count(F.lit(1)).alias("n_cases"),
        F.round(share_true(F.col("sex_match")), 4).alias("sex_accuracy"),
        F.round(share_true(F.col("age_match")), 4).alias("age_accuracy"),
        F.round(share_true(F.col("onset_match")), 4).alias("onset_accuracy"),
        F.round(guarded_corr(F.col("x_n_events"), F.col("gt_n_pts")), 4).alias("event_count_corr"),
    )
