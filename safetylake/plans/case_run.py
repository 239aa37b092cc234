"""Case processing: read reports once, run the chosen stages, write the audit records."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from safetylake import schemas as S
from safetylake.operators import stages
from safetylake.operators.grounding import candidate_lists, nearest_to
from safetylake.operators.mentions import read_reports, stated_date, vocabulary, with_run_id
from safetylake.plans.predict import USAGE, Predictor, checked, predict
from safetylake.session import stage_table

RULES_MODEL = "rules-v1"
# (verbatim) -> (verbatim, candidates): the terms a coding predictor chooses from
Grounder = Callable[[DataFrame], DataFrame]
JSON = {"ignoreNullFields": "false"}
CONFIDENCE = {
    "triage": "triage.confidence",
    "extraction": "extraction.confidence",
    "coding": "coding.confidence",
    "assessment": "assessment.confidence",
    "narrative_qc": "narrative_qc.overall_confidence",
}


@dataclass(frozen=True)
class Reference:
    """Global tables the stages may read."""

    dictionary: DataFrame  # pt_term, meddra_version
    products: DataFrame  # vax_name
    scope: DataFrame  # vax_name, in_scope
    phrases: DataFrame | None = None  # the vocabulary made of the three, where it is written already

    def written(self) -> Reference:
        """The same tables, dictionary and vocabulary written once for many runs."""
        dictionary = stage_table(self.dictionary, "dictionary")
        phrases = stage_table(vocabulary(dictionary, self.products, self.scope), "vocabulary")
        return replace(self, dictionary=dictionary, phrases=phrases)


def read(reports: DataFrame, ref: Reference, version: str, keep_text: bool = False) -> DataFrame:
    """Facts and mentions per report, and its narrative if kept; the vocabulary is written first so its size is known."""
    vocab = ref.phrases
    if vocab is None:
        vocab = stage_table(vocabulary(ref.dictionary, ref.products, ref.scope), "vocabulary")
    return read_reports(with_run_id(reports, version), vocab, keep_text)


def report_prompt(vaers_id: Column, narrative: Column) -> Column:
    return F.concat(F.lit("Report "), vaers_id, F.lit(":\n\n"), narrative)


def stage_input(runs: DataFrame, stage: str) -> Column:
    """Text a predictor of the last two stages gets; triage and extraction get the report itself."""
    if stage == "assessment":
        coded = F.col("coding.result.coded") if "coding" in runs.columns else None
        summary = stages.case_summary(F.col("extraction.case"), coded)
        return F.concat(F.lit("Case "), F.col("vaers_id"), F.lit(", to be assessed:\n\n"), summary)
    return F.concat(
        F.lit("Case "), F.col("vaers_id"), F.lit(", all stages:\n\n"),
        stages.assembled_json(runs.columns),
    )


def nearest_terms(dictionary: DataFrame, k: int = S.TOP_K_TERMS) -> Grounder:
    """The default grounder: the ``k`` dictionary terms nearest by trigram vectors fitted on the dictionary."""

    def ground(verbatims: DataFrame) -> DataFrame:
        return candidate_lists(verbatims, nearest_to(verbatims, dictionary, k))

    return ground


def with_coding_prompts(runs: DataFrame, grounder: Grounder) -> DataFrame:
    """The runs with ``input_text``: their events with the candidate terms of each."""
    verbatims = runs.select(F.explode("extraction.case.events.verbatim").alias("verbatim")).distinct()
    candidates = stage_table(grounder(verbatims), "candidates")
    return stages.with_candidates(runs, candidates, [c for c in runs.columns if c != "run_id"])


def restated(runs: DataFrame, predicted: set[str]) -> DataFrame:
    """Facts of the rule reader replaced by what predictors found, for the stages that follow."""
    stated = F.col("stated")
    if "triage" in predicted:
        flagged = F.col("triage.seriousness_screen.criteria_flagged")
        stated = stated.withField("criteria", F.coalesce(flagged, F.array().cast("array<string>")))
    if "extraction" in predicted:
        case = F.col("extraction.case")
        stated = (
            stated.withField("vaccination_date", stated_date(case["vaccination_date"]))
            .withField("onset_date", stated_date(case["onset_date"]))
            .withField("stated_days", case["days_to_onset"].cast("bigint"))
            .withField("age_years", case["patient"]["age_years"].cast("double"))
            .withField("sex", case["patient"]["sex"])
        )
    return runs.withColumn("stated", stated) if predicted else runs


def replace_stage(runs: DataFrame, stage: str, predictor: Predictor) -> tuple[DataFrame, DataFrame]:
    """Put a predictor's checked outputs for ``input_text`` in place of a stage: (runs, failures).

    The rows of the runs pass through the predictor and are written once with what it said, before they are split: it
    sees each case once, and no join brings cases and outputs together. Failed cases leave the run and are returned
    with their error.
    """
    keep = [c for c in runs.columns if c not in ("run_id", "input_text", stage)]
    return checked(predict(runs, predictor, keep), stage, keep)


def _minimum(columns: list[Column]) -> Column:
    return F.least(*columns) if len(columns) > 1 else columns[0]


def run_cases(
    reports: DataFrame,
    ref: Reference,
    chosen: tuple[str, ...] = tuple(S.STAGES),
    version: str = S.PIPELINE_VERSION["full"],
    threshold: float = S.HITL_THRESHOLD,
    minor_terms: list[str] = stages.MINOR_TERMS,
) -> DataFrame:
    """One row per run: a struct per chosen stage, the overall confidence and the routing.

    ``reports`` holds vaers_id, narrative and received_date. Extraction always runs; any
    other stage may be left out and the rest keep their order.
    """
    return run_with_predictors(reports, ref, {}, chosen, version, threshold, minor_terms)[0]


def run_with_predictors(
    reports: DataFrame,
    ref: Reference,
    predictors: dict[str, Predictor],
    chosen: tuple[str, ...] = tuple(S.STAGES),
    version: str = S.PIPELINE_VERSION["full"],
    threshold: float = S.HITL_THRESHOLD,
    minor_terms: list[str] = stages.MINOR_TERMS,
    grounder: Grounder | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """``run_cases`` with some stages done by predictors: (runs, failures or None).

    A case whose predictor fails or breaks its contract is left out of the runs and listed in
    the failures (run_id, stage, error, vaers_id); all others go on. Stages after a predictor read
    its output, not what the rules read. ``grounder`` gives a coding predictor its candidates, the
    nearest dictionary terms by default.
    """
    chosen = tuple(s for s in S.STAGES if s in chosen or s == "extraction")
    failures: list[DataFrame] = []

    def swap(runs: DataFrame, stage: str) -> DataFrame:
        runs, bad = replace_stage(runs, stage, predictors[stage])
        failures.append(bad)
        return runs

    from_text = [s for s in ("triage", "extraction") if s in chosen and s in predictors]
    runs = stages.extraction(read(reports, ref, version, keep_text=bool(from_text)))
    if "triage" in chosen:
        runs = stages.triage(runs, minor_terms)
    runs = runs.drop("events", "products", "linked")
    for stage in from_text:
        runs = runs.withColumn("input_text", report_prompt(F.col("vaers_id"), F.col("narrative")))
        runs = swap(runs.drop("narrative") if stage == from_text[-1] else runs, stage)
    runs = restated(runs, set(from_text))
    if "coding" in chosen and not from_text:
        # Reading the text is the costly part: write its result before it is used twice,
        # for the distinct verbatims and for the cases themselves. A predictor's outputs are written with it.
        runs = stage_table(runs, "read")
    for stage in ("coding", "assessment", "narrative_qc"):
        if stage not in chosen:
            continue
        if stage in predictors:
            if stage == "coding":
                runs = with_coding_prompts(runs, grounder or nearest_terms(ref.dictionary))
            else:
                runs = runs.withColumn("input_text", stage_input(runs, stage))
            runs = swap(runs, stage)
        elif stage == "coding":
            verbatims = runs.select(F.explode("extraction.case.events.verbatim").alias("verbatim"))
            coded = stage_table(stages.code_terms(verbatims, ref.dictionary), "coded")
            runs = stages.coding(runs, coded, [c for c in runs.columns if c != "run_id"])
        elif stage == "assessment":
            runs = stages.assessment(runs)
        else:
            runs = stages.narrative_qc(runs, threshold)
    runs = route(runs, chosen, threshold).withColumn("pipeline_version", F.lit(version))
    failed = reduce(DataFrame.unionByName, failures) if failures else None
    return runs, failed


def store(runs: DataFrame) -> DataFrame:
    """Write the runs once, for the record tables that are made from them."""
    return stage_table(runs, "runs")


def failed_runs(failures: DataFrame, version: str, models: dict[str, str] | None = None) -> DataFrame:
    """Run records of the cases a predictor failed on, one per run, with the model of the stage that failed."""
    model = F.lit(None).cast("string")
    for stage in S.STAGES:
        named = F.to_json(F.struct(_model(models, stage).alias(S.STAGE_MODEL_KEY[stage])))
        model = F.when(F.col("stage") == stage, named).otherwise(model)
    return failures.groupBy("run_id", "vaers_id").agg(
        F.lit(version).alias("pipeline_version"), F.max(model).alias("model_config"), F.lit("failed").alias("status"),
        F.lit(None).cast("double").alias("overall_confidence"), F.lit(None).cast("boolean").alias("hitl_required"),
        F.current_timestamp().alias("started_at"), F.current_timestamp().alias("finished_at"),
    )


def route(runs: DataFrame, chosen: tuple[str, ...], threshold: float = S.HITL_THRESHOLD) -> DataFrame:
    """Overall confidence = the lowest present; review when low, uncoded or recommended."""
    overall = _minimum([F.col(CONFIDENCE[s]) for s in chosen])
    uncoded = F.size("coding.result.uncoded") if "coding" in chosen else F.lit(0)
    asked = F.col("narrative_qc.hitl_recommended") if "narrative_qc" in chosen else F.lit(False)
    return runs.withColumn("overall_confidence", overall).withColumn(
        "hitl_required",
        hitl_required(F.col("overall_confidence"), uncoded, asked, threshold),
    )


def hitl_required(
    overall: Column, n_uncoded: Column, recommended: Column, threshold: float = S.HITL_THRESHOLD
) -> Column:
    return (overall < threshold) | (n_uncoded > 0) | F.coalesce(recommended, F.lit(False))


def _present(runs: DataFrame) -> list[str]:
    return [s for s in S.STAGES if s in runs.columns]


def _model(models: dict[str, str] | None, stage: str) -> Column:
    return F.lit((models or {}).get(stage, RULES_MODEL))


def _usage(runs: DataFrame, stage: str, name: str) -> Column:
    """What a predictor used for a stage; 0 where the rules ran."""
    column = f"usage_{stage}"
    return F.col(f"{column}.{name}") if column in runs.columns else F.lit(0).cast("bigint")


def step_events(runs: DataFrame, models: dict[str, str] | None = None) -> DataFrame:
    """One row per stage that ran, numbered 1..n in stage order, with input and output hashes.

    ``models`` names the model of each stage that a predictor did; the others ran by rules, without
    tokens and with no time of their own.
    """
    verbatims = F.array_join("extraction.case.events.verbatim", " | ")
    input_hash = {
        "triage": F.col("input_hash"),
        "extraction": F.col("input_hash"),
        "coding": F.sha2(verbatims, 256),
        "assessment": F.sha2("vaers_id", 256),
        "narrative_qc": F.sha2("vaers_id", 256),
    }
    entries = [
        F.struct(
            F.lit(seq).cast("bigint").alias("seq"),
            F.lit(stage).alias("agent_name"),
            F.lit(S.STAGE_VERSION[stage]).alias("agent_version"),
            F.lit(S.STAGE_PROMPT_VERSION[stage]).alias("prompt_version"),
            _model(models, stage).alias("model"),
            input_hash[stage].alias("input_hash"),
            F.to_json(F.col(stage), JSON).alias("output"),
            F.col(CONFIDENCE[stage]).alias("confidence"),
            *[_usage(runs, stage, name).alias(name) for name in USAGE],
        )
        for seq, stage in enumerate(_present(runs), 1)
    ]
    return runs.select("run_id", "vaers_id", F.inline(F.array(*entries))).select(
        F.sha2(F.concat_ws("|", "run_id", "seq"), 256).alias("event_id"),
        "run_id", "vaers_id", "seq", "agent_name", "agent_version",
        "model", "prompt_version", "input_hash", "output", "confidence",
        *USAGE,
        F.current_timestamp().alias("created_at"),
    )


def _json_or_null(runs: DataFrame, stage: str, path: str) -> Column:
    if stage not in runs.columns:
        return F.lit(None).cast("string")
    return F.to_json(F.col(path), JSON)


def case_output(runs: DataFrame, model: str = RULES_MODEL) -> DataFrame:
    """The assembled case, one row per run."""
    if "coding" in runs.columns:
        coded = F.transform(F.col("coding.result.coded"), lambda c: c["meddra_pt"])
    else:
        coded = F.array().cast("array<string>")
    narrative = "narrative_qc" in runs.columns
    return runs.select(
        "run_id", "vaers_id", "pipeline_version",
        F.lit(model).alias("model"),
        F.to_json("extraction.case", JSON).alias("extracted"),
        coded.alias("coded_pts"),
        _json_or_null(runs, "coding", "coding.result").alias("coded_detail"),
        _json_or_null(runs, "assessment", "assessment.seriousness").alias("seriousness"),
        _json_or_null(runs, "assessment", "assessment.causality").alias("causality"),
        (F.col("narrative_qc.narrative") if narrative else F.lit(None).cast("string")).alias("narrative"),
        "overall_confidence", "hitl_required",
        F.current_timestamp().alias("created_at"),
    )


def run_record(runs: DataFrame, models: dict[str, str] | None = None, status: str = "completed") -> DataFrame:
    """One row per run with the model of each stage that ran."""
    named = F.struct(*[_model(models, s).alias(S.STAGE_MODEL_KEY[s]) for s in _present(runs)])
    return runs.select(
        "run_id", "vaers_id", "pipeline_version",
        F.to_json(named).alias("model_config"),
        F.lit(status).alias("status"),
        "overall_confidence", "hitl_required",
        F.current_timestamp().alias("started_at"),
        F.current_timestamp().alias("finished_at"),
    )


def case_results(runs: DataFrame) -> DataFrame:
    """Per-run result figures."""
    has = set(runs.columns)
    size = lambda stage, path: (F.size(path) if stage in has else F.lit(0)).cast("bigint")
    return runs.select(
        "run_id", "vaers_id",
        F.lit(len(_present(runs))).cast("bigint").alias("steps"),
        F.col("overall_confidence").alias("confidence"), "hitl_required",
        size("extraction", "extraction.case.events").alias("n_events"),
        size("extraction", "extraction.case.products").alias("n_products"),
        size("coding", "coding.result.coded").alias("n_coded"),
        size("coding", "coding.result.uncoded").alias("n_uncoded"),
        (F.col("assessment.seriousness.serious") if "assessment" in has else F.lit(None).cast("boolean")).alias("serious"),
    )


def run_summary(results: DataFrame, n_failed: int | Column = 0) -> DataFrame:
    """Runs processed, assessed serious and routed to review."""
    failed = n_failed if isinstance(n_failed, Column) else F.lit(n_failed)
    return results.agg(
        F.count(F.lit(1)).alias("ok"),
        F.count_if(F.coalesce("serious", F.lit(False))).alias("serious"),
        F.count_if("hitl_required").alias("hitl"),
        F.sum("n_events").alias("n_events"),
        F.sum("n_products").alias("n_products"),
        F.sum("n_coded").alias("n_coded"),
        F.sum("n_uncoded").alias("n_uncoded"),
    ).withColumn("failed", failed.cast("bigint"))
