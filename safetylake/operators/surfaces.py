"""Curated tables for reviewers: latest run, review queue, full case, live status."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from safetylake import schemas as S
from safetylake.functions.lookup import lookup

CLOSING_ACTIONS = ["approve", "reject"]
# status a case is in while the next stage after the logged one runs, in stage order
STATUS_AFTER = {
    "triage": "extracting",
    "extraction": "coding",
    "coding": "assessing",
    "assessment": "drafting",
    "narrative_qc": "in_review",
}
STATUS_OF_ACTION = {
    "approve": "finalized",
    "edit": "in_review",
    "reject": "failed",
    "escalate": "in_review",
}


def latest_run(outputs: DataFrame) -> DataFrame:
    """Newest run of each case, ties by run id.

    Spark keeps one row per case on the map side already (window group limit), so a case
    with very many runs does not gather in one task.
    """
    newest = Window.partitionBy("vaers_id").orderBy(
        F.col("created_at").desc_nulls_last(), F.col("run_id").desc()
    )
    return outputs.withColumn("rn", F.row_number().over(newest)).filter("rn = 1").drop("rn")


def review_queue(outputs: DataFrame, reviews: DataFrame) -> DataFrame:
    """Latest runs that need a reviewer and have no closing action, least confident first."""
    closed = reviews.filter(F.col("action").isin(CLOSING_ACTIONS)).select("run_id").distinct()
    return (
        latest_run(outputs)
        .filter("hitl_required")
        .join(closed, "run_id", "left_anti")
        .select(
            "vaers_id", "run_id", "pipeline_version", "overall_confidence",
            "narrative", "coded_pts", "seriousness", "created_at",
        )
        .orderBy(F.col("overall_confidence").asc_nulls_first(), "vaers_id")
    )


def case_full(facts: DataFrame, outputs: DataFrame, evaluated: DataFrame) -> DataFrame:
    """Report, ground truth, latest run and its scores, one row per report row.

    ``facts`` is the ground truth with ``symptom_text`` kept, so the report table is not
    joined with itself and a report loaded many times stays linear.
    """
    run = latest_run(outputs).select(
        "vaers_id", "run_id", "pipeline_version", "extracted", "coded_pts", "seriousness",
        "causality", "narrative", "overall_confidence", "hitl_required",
    )
    scores = evaluated.select(
        "vaers_id", F.col("run_id").alias("scored_id"),
        F.col("f1").alias("coding_f1"),
        F.col("precision").alias("coding_precision"),
        F.col("recall").alias("coding_recall"),
        "seriousness_match",
    )
    # A run belongs to one case, so joining its scores on (case, run) is joining them on run. The latest runs are dealt
    # by case, once, for both joins: there the run is not a key but compared among the scores of its case.
    same = F.coalesce(F.col("run_id") == F.col("scored_id"), F.lit(False))
    run = run.join(scores.withColumnRenamed("vaers_id", "case"), (F.col("vaers_id") == F.col("case")) & same, "left")
    run = run.drop("case", "scored_id")
    report = facts.select(
        "vaers_id", "symptom_text", "age_yrs", "sex", F.col("serious").alias("gt_serious"), "n_coded_pts"
    )
    return report.join(run, "vaers_id", "left")


def status_events(steps: DataFrame, reviews: DataFrame | None = None) -> DataFrame:
    """Step and review events as one log of status changes."""
    log = steps.select(
        "vaers_id",
        F.col("created_at").alias("updated_at"),
        F.col("event_id").alias("event_key"),
        F.coalesce(lookup(F.col("agent_name"), STATUS_AFTER), F.lit("received")).alias("current_status"),
        F.col("run_id").alias("current_run_id"),
        F.col("confidence").alias("overall_confidence"),
        F.lit(None).cast("string").alias("assigned_reviewer"),
    )
    if reviews is None:
        return log
    return log.unionByName(
        reviews.select(
            "vaers_id",
            F.col("reviewed_at").alias("updated_at"),
            F.col("review_id").alias("event_key"),
            F.coalesce(lookup(F.col("action"), STATUS_OF_ACTION), F.lit("in_review")).alias("current_status"),
            F.col("run_id").alias("current_run_id"),
            F.lit(None).cast("double").alias("overall_confidence"),
            F.col("reviewer_id").alias("assigned_reviewer"),
        )
    )


def fold_status(events: DataFrame) -> DataFrame:
    """Newest status per case and the newest known confidence and reviewer.

    Works on a batch frame and, unchanged, on a stream.
    """
    order = F.struct("updated_at", "event_key")
    last_known = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c)
    return events.groupBy("vaers_id").agg(
        F.max_by("current_status", order).alias("current_status"),
        F.max_by("current_run_id", order).alias("current_run_id"),
        last_known("overall_confidence"),
        last_known("assigned_reviewer"),
        F.max("updated_at").alias("updated_at"),
    )


def case_status(
    steps: DataFrame, reviews: DataFrame | None = None, threshold: float = S.HITL_THRESHOLD
) -> DataFrame:
    """Current state of each case, from its append-only logs."""
    return with_hitl(fold_status(status_events(steps, reviews)), threshold)


def with_hitl(status: DataFrame, threshold: float = S.HITL_THRESHOLD) -> DataFrame:
    return status.withColumn("hitl_required", F.col("overall_confidence") < threshold)


def open_cases(status: DataFrame) -> DataFrame:
    """Cases in review, least confident first."""
    return status.filter(F.col("current_status") == "in_review").orderBy(
        F.col("overall_confidence").asc_nulls_first(), "vaers_id"
    )


def case_progress(steps: DataFrame) -> DataFrame:
    """Per-case progress log."""
    return steps.select(
        "vaers_id",
        "event_id",
        "seq",
        "agent_name",
        F.coalesce(lookup(F.col("agent_name"), STATUS_AFTER), F.lit("received")).alias("status"),
        "confidence",
        F.col("created_at").alias("ts"),
    )


def active_versions(dashboard: DataFrame, versions: DataFrame) -> DataFrame:
    """Dashboard rows of the versions that are active, with their deployment facts."""
    return dashboard.join(versions.filter("active"), "pipeline_version")
