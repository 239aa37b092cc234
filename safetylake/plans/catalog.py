"""Named queries: each composes operators over the star-schema tables of one folder."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from safetylake import schemas as S
from safetylake.functions import text
from safetylake.operators import (
    concordance,
    contracts,
    evaluation,
    grounding,
    reference,
    signals,
    stages,
    surfaces,
    truth,
)
from safetylake.operators.mentions import with_run_id
from safetylake.plans import case_run
from safetylake.plans.predict import Predictor, checked, predict
from safetylake.session import new_path, stage_table, tune
from safetylake.sources import reports, star, tables
from safetylake.streaming import jobs, sink

VERSION = "pipeline@0.2"
MINOR_TERMS = [
    "hot anvil", "hot bolt", "hot gear", "hot gizmo", "hot plate", "hot ring", "hot rod", "hot widget",
]
Query = Callable[[SparkSession, str], DataFrame]


class Inputs:
    """The report-shaped inputs and the shared frames built from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tune(spark), sf_dir

    def view(self, name: str) -> DataFrame:
        return getattr(star, name)(self.spark, self.sf_dir)

    @cached_property
    def cases(self) -> DataFrame:
        return self.view("cases")

    @cached_property
    def vax(self) -> DataFrame:
        return self.view("vax")

    @cached_property
    def outputs(self) -> DataFrame:
        return self.view("outputs")

    @cached_property
    def long(self) -> DataFrame:
        return truth.symptoms_long(self.view("symptoms"))

    @cached_property
    def scope(self) -> DataFrame:
        # A reference table: written once, so every reader knows its size.
        return stage_table(reference.product_scope(self.vax, star.SCOPE_TYPE), "scope")

    @cached_property
    def scope_cases(self) -> DataFrame:
        return reference.in_scope_cases(self.vax, self.scope)

    @cached_property
    def dictionary(self) -> DataFrame:
        return reference.pt_dictionary(self.long, self.scope_cases)

    @cached_property
    def sliced(self) -> DataFrame:
        return reference.case_slice(self.cases, self.scope_cases)

    @cached_property
    def truth(self) -> DataFrame:
        return truth.gt_case(self.cases, self.vax, truth.gt_pt(self.long))

    @cached_property
    def seriousness(self) -> DataFrame:
        # Scoring needs the serious flag only, so the child counts of the full facts are not built.
        return truth.gt_seriousness(self.cases).select("vaers_id", "serious")

    @cached_property
    def newest(self) -> DataFrame:
        return stage_table(surfaces.latest_run(self.outputs), "newest")

    @cached_property
    def evaluated(self) -> DataFrame:
        return evaluation.eval_case(self.outputs, self.long, self.seriousness)

    @cached_property
    def compared(self) -> DataFrame:
        return evaluation.eval_extraction(self.view("extracted"), self.truth)

    @cached_property
    def exposure(self) -> DataFrame:
        return signals.case_exposure(self.outputs, self.scope_cases)

    @cached_property
    def cells(self) -> DataFrame:
        return signals.signal_cells(signals.case_event(self.outputs), self.exposure)

    @cached_property
    def metrics(self) -> DataFrame:
        return signals.signal_metrics(self.cells)


    @cached_property
    def by_scope(self) -> DataFrame:
        """Signals of every product type."""
        scopes = self.vax.select(F.col("vax_type").alias("product_scope"), "vax_name")
        exposed = signals.scope_exposure(self.outputs, self.vax, scopes)
        return signals.signal_metrics(signals.scope_cells(self.outputs, signals.case_event(self.outputs), exposed))

    @cached_property
    def ref(self) -> case_run.Reference:
        return case_run.Reference(self.listed, self.vax, self.scope)

    @cached_property
    def listed(self) -> DataFrame:
        return stage_table(self.dictionary, "dictionary")

    @cached_property
    def read(self) -> DataFrame:
        return case_run.read(self.view("narratives"), self.ref, S.PIPELINE_VERSION["full"])

    def run(self, *chosen: str, version: str = "full") -> DataFrame:
        return case_run.run_cases(
            self.view("narratives"), self.ref, chosen or tuple(S.STAGES),
            S.PIPELINE_VERSION[version], minor_terms=MINOR_TERMS,
        )


def _named(frame: str) -> Query:
    return lambda spark, sf_dir: getattr(Inputs(spark, sf_dir), frame)


def _using(build: Callable[[Inputs], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Inputs(spark, sf_dir))


def _foundation(i: Inputs) -> DataFrame:
    return reference.foundation_counts(i.scope, i.dictionary, i.sliced)


def _seriousness(i: Inputs) -> DataFrame:
    return truth.gt_seriousness(i.cases).withColumn(
        "criteria_met", F.array_join("criteria_met", ",")
    )


def _normalized_terms(i: Inputs) -> DataFrame:
    listed = i.outputs.select(F.explode("coded_pts").alias("term"))
    return listed.groupBy("term", text.normalize_pt(F.col("term")).alias("normal")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _normalized_products(i: Inputs) -> DataFrame:
    return i.vax.groupBy(
        "vax_name", text.normalize_product(F.col("vax_name")).alias("normal")
    ).agg(F.count(F.lit(1)).alias("n"))


def _demographics(i: Inputs) -> DataFrame:
    x = i.view("extracted").select(
        "vaers_id",
        evaluation.json_text("extracted", "$.patient.sex").alias("sex"),
        evaluation.json_text("extracted", "$.patient.age_years").try_cast("double").alias("age_years"),
    )
    return concordance.demographic_concordance(x, i.cases)


def _coding_sets(i: Inputs) -> DataFrame:
    run = F.concat_ws("|", "vaers_id", "run_id").alias("run")
    predicted = i.outputs.select(run, F.explode("coded_pts").alias("term"))
    human = i.long.select("vaers_id", F.col("pt_term").alias("term"))
    truth_of_run = i.outputs.select("vaers_id", run).distinct().join(human, "vaers_id").select("run", "term")
    return concordance.coding_concordance(predicted, truth_of_run, key="run")


def _product_recall(i: Inputs) -> DataFrame:
    # Stated products of a report: the first dose is not named, every third case gives bare
    # product types, the others the brand name in lower case.
    stated = i.vax.select(
        "vaers_id",
        F.when(F.col("vax_dose_series") == "1", F.lit("not named"))
        .when(F.col("vaers_id").cast("long") % 3 == 0, F.col("vax_type"))
        .otherwise(F.lower("vax_name"))
        .alias("product"),
    )
    wanted = i.vax.select("vaers_id", F.col("vax_name").alias("product"))
    return concordance.product_concordance(stated, wanted)


def _requests(i: Inputs) -> DataFrame:
    """Request rows taken from the event stream table: one request per event."""
    n = F.col("event_id")
    pick = lambda words, by: F.element_at(
        F.split(F.lit(words), ","), (n % by + 1).cast("int")
    )
    return star.table(i.spark, i.sf_dir, "events").select(
        n.alias("request_id"),
        pick("signal_metrics, Signal_Metrics ,case_output,signal_metrics,signal_metrics", 5).alias("source"),
        pick("select,SELECT,delete,select,drop,select,insert", 7).alias("operation"),
        pick("prr,ror,a,speed,c,n_total", 6).alias("metric"),
        F.when(n % 11 == 0, 2).otherwise(1).alias("n_statements"),
        F.when(n % 4 != 0, n % 250 - 5).alias("row_limit"),
    )


def _triage(i: Inputs) -> DataFrame:
    return stages.triage(i.read, MINOR_TERMS).select(
        "vaers_id", "triage.valid",
        F.array_join("triage.missing_criteria", ",").alias("missing_criteria"),
        "triage.seriousness_screen.serious",
        F.array_join("triage.seriousness_screen.criteria_flagged", ",").alias("criteria_flagged"),
        "triage.priority", "triage.confidence", "triage.rationale",
    )


def _extraction(i: Inputs) -> DataFrame:
    return stages.extraction(i.read).select(
        "vaers_id", F.to_json("extraction.case", case_run.JSON).alias("extracted"),
        "extraction.confidence",
    )


def _ground(i: Inputs) -> DataFrame:
    tops = grounding.ground_topk(i.view("query_vectors"), i.view("term_vectors"))
    return tops.withColumn("score", F.round("score", 6)).withColumn("rank", F.col("rank").cast("bigint"))


def _embedded(i: Inputs) -> DataFrame:
    model = stage_table(grounding.fit_vectors(i.listed, "pt_term"), "vector-model")
    shown = F.zip_with(
        "vector.slots", "vector.weights",
        lambda slot, x: F.concat(slot.cast("string"), F.lit(":"), F.round(x * 1000000).cast("bigint").cast("string")),
    )
    return grounding.embed_terms(i.listed, "pt_term", model).select("pt_term", F.array_join(shown, ",").alias("vector"))


def _coded(i: Inputs) -> DataFrame:
    verbatims = i.outputs.select(F.explode("coded_pts").alias("verbatim"))
    return stages.code_terms(verbatims, i.listed)


def _candidates(i: Inputs) -> DataFrame:
    cases = stage_table(
        stages.extraction(i.read).select(
            "run_id", F.col("extraction.case.events.verbatim").alias("verbatims")
        ),
        "verbatims",
    )
    verbatims = cases.select(F.explode("verbatims").alias("verbatim")).distinct()
    tops = grounding.nearest_to(verbatims, i.listed, S.TOP_K_TERMS)
    return stages.render_candidates(cases, grounding.candidate_lists(verbatims, tops))


def _assessed(i: Inputs) -> DataFrame:
    return stages.assessment(stages.extraction(i.read)).select(
        "vaers_id", "assessment.seriousness.serious",
        F.array_join("assessment.seriousness.criteria_met", ",").alias("criteria_met"),
        "assessment.causality.category", "assessment.causality.rationale", "assessment.confidence",
    )


def _summary(i: Inputs) -> DataFrame:
    runs = i.run("extraction", "coding")
    text_column = stages.case_summary(F.col("extraction.case"), F.col("coding.result.coded"))
    return runs.select("vaers_id", text_column.alias("summary"))


def _qc(i: Inputs) -> DataFrame:
    flags = F.transform(
        "narrative_qc.qc_flags", lambda f: F.concat_ws(":", f["type"], f["severity"], f["detail"])
    )
    return i.run().select(
        "vaers_id", "narrative_qc.completeness.completeness_score",
        F.array_join("narrative_qc.completeness.gaps", ",").alias("gaps"),
        F.array_join(flags, "|").alias("flags"),
        F.col("narrative_qc.overall_confidence").alias("overall_confidence"),
        "narrative_qc.hitl_recommended",
    )


def _routes(i: Inputs) -> DataFrame:
    return (
        i.run()
        .groupBy(
            "hitl_required",
            F.col("narrative_qc.hitl_recommended").alias("recommended"),
            (F.col("overall_confidence") < S.HITL_THRESHOLD).alias("low_confidence"),
            (F.size("coding.result.uncoded") > 0).alias("has_uncoded"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


BATCH_ID = "batch-1"


def _write_csv(i: Inputs, name: str) -> str:
    """Report files as the public source ships them: header in capitals, Latin-1, packed (a file is what one task wrote)."""
    path = new_path(i.spark, f"csv-{name}")
    rows = i.view(name)
    rows.select(*[F.col(c).alias(c.upper()) for c in rows.columns]).write.options(
        header=True, encoding="ISO-8859-1", escape='"', emptyValue="", nullValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression="gzip",
    ).csv(path)
    return path


def _csv(i: Inputs) -> DataFrame:
    rows, _ = reports.read_report_csv(i.spark, _write_csv(i, "cases"))
    return rows.drop("_source_file")


def _conformed(i: Inputs) -> DataFrame:
    rows, _ = reports.read_report_csv(i.spark, _write_csv(i, "cases"))
    return reports.conform(rows, "raw_vaers_data", BATCH_ID).drop("_ingested_at", "_source_file")


def _load_counts(i: Inputs) -> DataFrame:
    files = {
        "raw_vaers_data": _write_csv(i, "cases"),
        "raw_vaers_vax": _write_csv(i, "vax"),
        "raw_vaers_symptoms": _write_csv(i, "symptoms"),
    }
    counts = reports.load_files(i.spark, files, new_path(i.spark, "raw"), BATCH_ID)
    rows = [(table, counts[table], counts["batch_id"]) for table in files]
    return i.spark.createDataFrame(rows, "table_name string, n bigint, batch_id string")


def _stored_steps(stored: DataFrame) -> DataFrame:
    return stored.select(
        "event_id", "run_id", "vaers_id", "seq", "agent_name", "confidence", "output",
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
    )


def _audit(i: Inputs) -> DataFrame:
    warehouse = new_path(i.spark, "audit")
    tables.append(i.view("steps"), warehouse, "agt_step_event")
    return _stored_steps(tables.read_table(i.spark, warehouse, "agt_step_event"))


def _views(i: Inputs) -> DataFrame:
    report = tables.register_views(
        i.spark,
        {
            "raw_vaers_vax": lambda _: i.vax,
            "ref_product_scope": lambda _: i.scope,
            "vw_scope_counts": lambda spark: spark.sql(
                "SELECT vax_name, count(*) AS n FROM raw_vaers_vax JOIN ref_product_scope USING (vax_name) "
                "GROUP BY vax_name"
            ),
        },
    )
    registered = sum(status == "ok" for _, status in report)
    return tables.query(
        i.spark,
        "SELECT vax_name, n, :registered AS n_views FROM vw_scope_counts WHERE n >= :least",
        {"registered": registered, "least": 1},
    )


# A sound output of every contract, and faults: text to replace and what stands there instead.
_CASE = (
    '{"patient":{"age_years":30,"sex":"male"},"products":[{"name":"X","role":"suspect"}],'
    '"events":[{"verbatim":"rash","outcome":"recovered"}],"days_to_onset":2}'
)
_CODED = '{"coded":[{"verbatim":"rash","meddra_pt":"Rash","confidence":0.9}],"uncoded":["itch"]}'
_GRAVE = '{"serious":true,"criteria_met":["death"]}'
_CAUSE = '{"method":"WHO-UMC","category":"possible","score":null,"rationale":"r"}'
SAMPLES: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "triage": (
        '{"valid":true,"missing_criteria":[],"seriousness_screen":{"serious":false,"criteria_flagged":[]},"priority":"standard","confidence":0.8}',
        [('"standard"', '"urgent"'), ('"confidence":0.8', '"confidence":-0.1'), ('"serious":false,', ""), ("[]}", '["none"]}'), ("true", '"perhaps"')],
    ),
    "extraction": (
        f'{{"case":{_CASE},"confidence":0.6}}',
        [('"male"', '"m"'), ('"days_to_onset":2', '"days_to_onset":2.5'), ('"recovered"', '"well"'), ('"name":"X",', ""), ("30", '"old"')],
    ),
    "coding": (
        f'{{"result":{_CODED},"confidence":0.9}}',
        [('"Rash"', "7"), ('"confidence":0.9}]', '"confidence":9}]'), ('"uncoded":["itch"]', '"uncoded":"itch"'), ('"result"', '"results"')],
    ),
    "assessment": (f'{{"seriousness":{_GRAVE},"causality":{_CAUSE},"confidence":0.8}}', [('"death"', "null"), ('"WHO-UMC"', '"guess"'), (',"rationale":"r"', "")]),
    "narrative_qc": (
        '{"narrative":"n","completeness":{"completeness_score":0.5,"gaps":["age"]},"qc_flags":[{"type":"missing_field","severity":"warning","detail":null}],'
        '"overall_confidence":0.9,"hitl_recommended":false}',
        [('"warning"', '"mild"'), ("0.5", "5"), ('"narrative":"n",', ""), ('"detail":null', '"detail":null,"more":1')],
    ),
    "signal": (
        '{"generated_sql":"q","results":[{"event_pt":"Rash","a":3,"prr":2.5,"other":1}],"summary":"s","caveats":[]}',
        [('"event_pt":"Rash",', ""), ('"a":3', '"a":null'), ('"summary":"s"', '"summary":1'), ('"caveats"', '"caveat"')],
    ),
    "assembled_case": (
        f'{{"run_id":"r","vaers_id":"v","extracted":{_CASE},"coded_pts":["Rash"],"coded_detail":{_CODED},"seriousness":{_GRAVE},'
        f'"causality":{_CAUSE},"narrative":"n","overall_confidence":0.7,"hitl_required":true}}',
        [('"coded_pts":["Rash"],', ""), ('"vaers_id":"v"', '"vaers_id":5'), ('"suspect"', '"main"'), ("0.7", "1.01")],
    ),
}


def _stage_outputs(i: Inputs) -> DataFrame:
    """case_key, contract and output: one per order, by turns sound and with each fault of its contract."""
    k = F.col("o_orderkey")
    text_of = F.lit(None).cast("string")
    for n, (sound, faults) in enumerate(SAMPLES.values()):
        fault = F.floor(k / len(SAMPLES)) % (len(faults) + 1)
        output = F.lit(sound)
        for f, (old, new) in enumerate(faults, 1):
            assert sound.count(old), old
            output = F.when(fault == f, F.lit(sound.replace(old, new, 1))).otherwise(output)
        text_of = F.when(k % len(SAMPLES) == n, output).otherwise(text_of)
    contract = F.element_at(F.array(*[F.lit(c) for c in SAMPLES]), (k % len(SAMPLES) + 1).cast("int"))
    return star.table(i.spark, i.sf_dir, "orders").select(k.alias("case_key"), contract.alias("contract"), text_of.alias("output"))


def _validated_stages(i: Inputs) -> DataFrame:
    outputs = stage_table(_stage_outputs(i), "outputs")
    parts = [contracts.validate(outputs.filter(F.col("contract") == name), "output", name) for name in SAMPLES]
    return reduce(DataFrame.unionByName, parts).select("case_key", "contract", "valid", F.array_join("errors", "|").alias("errors"))


def _broken_outputs(i: Inputs) -> DataFrame:
    """Assessment outputs as JSON text, one per order, many with a fault."""
    k = F.col("o_orderkey")
    text_if = lambda cond, words, other="": F.when(cond, F.lit(words)).otherwise(F.lit(other))
    category = F.element_at(
        F.split(F.lit("certain,probable,possible,unlikely,conditional,surely"), ","), (k % 6 + 1).cast("int")
    )
    criteria = (
        F.when(k % 5 == 0, '"death"')
        .when(k % 5 == 1, '"death","hospitalization"')
        .when(k % 5 == 2, '"unheard_of","death"')
        .otherwise("")
    )
    output = F.concat(
        F.lit('{"seriousness":{"serious":'), text_if(k % 23 == 0, '"maybe"', "true"),
        F.lit(',"criteria_met":['), criteria, F.lit(']},"causality":{"method":"'),
        text_if(k % 31 == 0, "guess", "WHO-UMC"), F.lit('","category":"'), category, F.lit('","score":'),
        text_if(k % 2 == 0, "null", "5"), text_if(k % 37 != 0, ',"rationale":"r"'), F.lit('},"confidence":'),
        text_if(k % 41 == 0, "1.7", "0.8"), text_if(k % 43 == 0, ',"extra":1'), F.lit("}"),
    )
    return star.table(i.spark, i.sf_dir, "orders").select(
        k.alias("case_key"), F.when(k % 47 == 0, "not json").otherwise(output).alias("output")
    )


def _validated(i: Inputs) -> DataFrame:
    return contracts.validate(_broken_outputs(i), "output", "assessment").select(
        "case_key", "valid", F.array_join("errors", "|").alias("errors")
    )


def _failed(i: Inputs) -> DataFrame:
    """Cases lost to a predictor that cannot read some reports and breaks its contract on others."""

    def predictor(prompts):
        def one(prompt):
            if "fatal" in prompt:
                raise ValueError("unreadable report")
            confidence = 1.7 if "Life-threatening" in prompt else 0.8
            return '{"case":{"patient":{"sex":"unknown"}},"confidence":%s}' % confidence

        return [one(p) for p in prompts]

    # A predictor is dear: copies of a report go through it once.
    cases = with_run_id(i.view("narratives"), "predicted").dropDuplicates(["run_id"])
    prompts = cases.select(
        "run_id", "vaers_id",
        case_run.report_prompt(F.col("vaers_id"), F.col("narrative")).alias("input_text"),
    )
    _, failures = checked(predict(prompts, predictor), "extraction")
    return failures.join(cases.select("run_id", "vaers_id"), "run_id").select(
        "vaers_id", "stage", "error"
    )


def _stand_ins() -> dict[str, Predictor]:
    """A predictor per stage that answers by plain rules; some fail, some break their contract."""

    def each(answer):
        def predictor(prompts):
            outputs = [json.dumps(answer(p)) for p in prompts]
            return [(o, len(p), len(p) % 7) for o, p in zip(outputs, prompts, strict=True)]

        return predictor

    def triage(prompt):
        if "Congenital" in prompt:
            raise ValueError("unreadable report")
        screen = {"serious": "fatal" in prompt, "criteria_flagged": ["death"] if "fatal" in prompt else []}
        return {"valid": True, "missing_criteria": [], "seriousness_screen": screen, "priority": "standard", "confidence": 0.9}

    def extraction(prompt):
        listed = re.search(r"Events: ([^.]*)\.", prompt).group(1)
        days = re.search(r"Symptoms began (\d+) days", prompt)
        events = [] if listed == "none stated" else [{"verbatim": e} for e in listed.split("; ")]
        case = {"patient": {"sex": "unknown"}, "events": events, "days_to_onset": int(days.group(1)) if days else None}
        return {"case": case, "confidence": 1.7 if "Left disabled" in prompt else 0.95}

    def coding(prompt):
        pairs = re.findall(r"\d+\. Event: (.*)\n   Candidate PTs: (.*)", prompt)
        first = [(event, terms.split("; ")[0]) for event, terms in pairs]
        coded = [{"verbatim": e, "meddra_pt": t, "confidence": 0.8} for e, t in first if t != stages.NO_CANDIDATES]
        uncoded = [e for e, t in first if t == stages.NO_CANDIDATES]
        return {"result": {"coded": coded, "uncoded": uncoded}, "confidence": 0.8 if coded else 0.7}

    def assessment(prompt):
        category = "unassessable" if "days to onset: None" in prompt else "possible"
        causality = {"method": "WHO-UMC", "category": category, "rationale": "by rule"}
        return {"seriousness": {"serious": "Coded events" in prompt, "criteria_met": []}, "causality": causality, "confidence": 0.9}

    def narrative(prompt):
        told = "A serious case." if '"serious":true' in prompt else "A case."
        return {
            "narrative": told, "completeness": {"completeness_score": 0.5, "gaps": []}, "qc_flags": [],
            "overall_confidence": 0.85, "hitl_recommended": '"category":"possible"' in prompt,
        }

    answers = {"triage": triage, "extraction": extraction, "coding": coding, "assessment": assessment, "narrative_qc": narrative}
    return {stage: each(answer) for stage, answer in answers.items()}


def _predicted_run(i: Inputs) -> DataFrame:
    """All five stages by predictors: one row per run, the failed ones with their error."""
    models = {stage: f"stand-in-{stage}" for stage in S.STAGES}
    version = S.PIPELINE_VERSION["full"]
    runs, failures = case_run.run_with_predictors(i.view("narratives"), i.ref, _stand_ins(), version=version)
    runs = case_run.store(runs)
    failures = stage_table(failures, "failures")
    steps = case_run.step_events(runs, models).groupBy("run_id").agg(
        F.array_join(F.array_sort(F.collect_list("model")), ",").alias("models"),
        F.sum(F.when(F.col("agent_name") == "triage", F.col("input_tokens"))).alias("triage_tokens"),
        F.min("latency_ms").alias("latency"),
    )
    told = runs.select(
        "run_id", F.array_join("coding.result.coded.meddra_pt", "|").alias("coded_pts"), "assessment.seriousness.serious",
        "assessment.causality.category", "narrative_qc.narrative",
    )
    done = case_run.run_record(runs, models).join(told, "run_id").join(steps, "run_id").where("latency >= 0")
    lost = case_run.failed_runs(failures, version, models).join(failures.select("run_id", "stage", "error"), "run_id")
    return done.drop("latency").unionByName(lost, allowMissingColumns=True).drop(*CLOCK)


def _active(i: Inputs) -> DataFrame:
    versions = i.outputs.groupBy("pipeline_version").agg(F.min("created_at").alias("deployed_at"))
    versions = versions.withColumn("active", F.col("pipeline_version") == VERSION)
    return surfaces.active_versions(evaluation.eval_dashboard(i.evaluated), versions)


def _event_stream(i: Inputs) -> DataFrame:
    schema = star.table(i.spark, i.sf_dir, "events").schema
    events = jobs.file_stream(i.spark, f"{i.sf_dir}/event[s].parquet", schema)
    return star.steps_of(events.withColumn("ts", F.col("ts").cast("timestamp")))


def _stream_audit(i: Inputs) -> DataFrame:
    # The events carry no stage outputs: triage steps get one, some of them against its contract.
    n = F.substring("event_id", 5, 20).cast("long")
    triage = F.concat(
        F.lit('{"valid":true,"missing_criteria":[],"seriousness_screen":{"serious":false,"criteria_flagged":[]},"priority":"'),
        F.when(n % 10 == 0, "soon").otherwise("standard"), F.lit('","confidence":'),
        F.when(n % 7 == 0, "7").otherwise("0.5"), F.lit("}"),
    )
    output = F.when(F.col("agent_name") == "triage", triage).otherwise(F.col("output"))
    warehouse = new_path(i.spark, "stream")
    stream = _event_stream(i).withColumn("output", output)
    jobs.audit_stream(stream, warehouse, new_path(i.spark, "checkpoint"), ("triage",)).awaitTermination()
    stored = _stored_steps(sink.read_stream_table(i.spark, warehouse, "agt_step_event"))
    apart = _stored_steps(i.spark.read.parquet(f"{tables.table_path(warehouse, jobs.QUARANTINE)}"))
    return stored.withColumn("kept", F.lit(True)).unionByName(apart.withColumn("kept", F.lit(False)))


def _stream_status(i: Inputs) -> DataFrame:
    warehouse = new_path(i.spark, "stream")
    jobs.status_stream(_event_stream(i), warehouse, new_path(i.spark, "checkpoint")).awaitTermination()
    return jobs.read_status(i.spark, warehouse).withColumn(
        "updated_at", F.col("updated_at").cast("timestamp_ntz")
    )


def _stream_intake(i: Inputs) -> DataFrame:
    landing, warehouse = new_path(i.spark, "landing"), new_path(i.spark, "stream")
    i.view("narratives").write.parquet(landing)
    stream = jobs.file_stream(i.spark, landing, i.view("narratives").schema)
    jobs.intake_stream(
        stream, i.ref, i.scope_cases, warehouse, new_path(i.spark, "checkpoint"), min_chars=INTAKE_CHARS
    ).awaitTermination()
    stored = sink.read_stream_table(i.spark, warehouse, "agt_case_output")
    return stored.select(
        "run_id", "vaers_id", F.array_join("coded_pts", "|").alias("coded_pts"), "seriousness",
        "narrative", "overall_confidence", "hitl_required",
    )


INTAKE_CHARS = 120
def _scored_run(i: Inputs) -> DataFrame:
    """Run every report, score the runs against the human codes, list their causality."""
    version = S.PIPELINE_VERSION["full"]
    done = stage_table(case_run.case_output(i.run()), "outputs")
    facts = truth.gt_seriousness(i.cases).select("vaers_id", "serious")
    board = evaluation.eval_dashboard(evaluation.eval_case(done, i.long, facts))
    causality = evaluation.causality_distribution(done, version)
    return board.join(causality.withColumn("pipeline_version", F.lit(version)), "pipeline_version")


def _slice_run(i: Inputs) -> DataFrame:
    """Run the in-scope cases with a long free-text narrative, whole texts of any length."""
    chosen = i.sliced.select(
        "vaers_id", F.col("symptom_text").alias("narrative"), F.col("recvdate").alias("received_date")
    )
    runs = case_run.store(case_run.run_cases(chosen, i.ref, minor_terms=MINOR_TERMS))
    texts = runs.select(
        "run_id", F.col("triage.rationale").alias("triage_rationale"), "narrative_qc.narrative"
    )
    return case_run.case_results(runs).join(texts, "run_id")


CLOCK = ["input_tokens", "output_tokens", "latency_ms", "created_at", "started_at", "finished_at"]


QUERIES: dict[str, Query] = {
    # sources and sinks
    "csv_ingest": _using(_csv),
    "conform_raw": _using(_conformed),
    "load_counts": _using(_load_counts),
    "audit_append": _using(_audit),
    "register_views": _using(_views),
    # reference derivation
    "product_scope": _named("scope"),
    "in_scope_cases": _named("scope_cases"),
    "pt_dictionary": _named("dictionary"),
    "demo_slice": _named("sliced"),
    "foundation_counts": _using(_foundation),
    "pt_list": _using(lambda i: reference.pt_list(i.dictionary)),
    "case_pick": _using(lambda i: reference.case_pick(i.sliced)),
    # ground truth
    "symptoms_long": _named("long"),
    "gt_pt": _using(lambda i: truth.gt_pt(i.long)),
    "gt_case": _named("truth"),
    "gt_seriousness": _using(_seriousness),
    # evaluation
    "eval_case": _named("evaluated"),
    "eval_dashboard": _using(lambda i: evaluation.eval_dashboard(i.evaluated)),
    "eval_extraction": _named("compared"),
    "extraction_scorecard": _using(lambda i: evaluation.extraction_scorecard(i.compared)),
    "coding_scorecard": _using(lambda i: evaluation.coding_scorecard(i.evaluated, VERSION)),
    "worst_cases": _using(lambda i: evaluation.worst_cases(i.evaluated, VERSION)),
    "full_scorecard": _using(lambda i: evaluation.full_scorecard(i.evaluated, VERSION)),
    "causality_distribution": _using(lambda i: evaluation.causality_distribution(i.outputs, VERSION)),
    # concordance
    "coding_prf": _using(_coding_sets),
    "normalize_pt": _using(_normalized_terms),
    "sex_match": _using(lambda i: _demographics(i).select("vaers_id", "x_sex", "gt_sex", "sex_match")),
    "age_match": _using(lambda i: _demographics(i).select("vaers_id", "x_age", "gt_age", "age_match")),
    "normalize_product": _using(_normalized_products),
    "product_recall": _using(_product_recall),
    # signals
    "case_exposure": _named("exposure"),
    "case_event": _using(lambda i: signals.case_event(i.outputs)),
    "signal_cells": _named("cells"),
    "signal_metrics": _using(lambda i: signals.signal_report(i.metrics)),
    "signal_query": _using(lambda i: signals.signal_query(i.metrics, "ror", min_count=100, pattern="g", limit=40)[0]),
    "signal_by_scope": _named("by_scope"),
    "signal_scope_query": _using(
        lambda i: signals.signal_query(i.by_scope, "a", min_count=2, limit=40, product_scope=star.SCOPE_TYPE)[0]
    ),
    "signal_rows": _using(lambda i: signals.signal_rows(i.metrics.select("event_pt", "a", "prr", "signal_flag"))),
    "screen_requests": _using(lambda i: signals.screen_requests(_requests(i), ["signal_metrics"])),
    # curated surfaces
    "latest_run": _using(lambda i: surfaces.latest_run(i.outputs).select("vaers_id", "run_id", "pipeline_version", "created_at")),
    "review_queue": _using(lambda i: surfaces.review_queue(i.outputs, i.view("reviews")).withColumn("coded_pts", F.array_join("coded_pts", "|"))),
    "case_full": _using(
        lambda i: surfaces.case_full(
            truth.gt_case(i.cases, i.vax, truth.gt_pt(i.long), keep=("symptom_text",)),
            i.newest.withColumn("extracted", F.lit(None).cast("string")),
            evaluation.eval_case(i.newest, i.long, i.seriousness),
        ).withColumn("coded_pts", F.array_join("coded_pts", "|"))
    ),
    "case_status": _using(lambda i: surfaces.case_status(i.view("steps"))),
    "open_cases": _using(lambda i: surfaces.open_cases(surfaces.case_status(i.view("steps"), i.view("reviews")))),
    "case_progress": _using(lambda i: surfaces.case_progress(i.view("steps"))),
    # case-processing stages
    "triage": _using(_triage),
    "extract_case": _using(_extraction),
    "ground_topk": _using(_ground),
    "ground_null": _using(
        lambda i: grounding.ground_null(i.view("query_vectors")).select(
            "verbatim", F.size("candidates").cast("bigint").alias("n_candidates")
        )
    ),
    "embed_terms": _using(_embedded),
    "code_events": _using(_coded),
    "render_candidates": _using(_candidates),
    "assess": _using(_assessed),
    "case_summary": _using(_summary),
    "narrative": _using(lambda i: i.run().select("vaers_id", "narrative_qc.narrative")),
    "qc_flags": _using(_qc),
    # whole runs
    "step_events": _using(lambda i: case_run.step_events(i.run()).drop(*CLOCK)),
    "run_two_stage": _using(
        lambda i: case_run.case_results(i.run("extraction", "coding", version="two_stage"))
    ),
    "run_full": _using(lambda i: case_run.case_results(i.run())),
    "hitl_route": _using(_routes),
    "case_output": _using(
        lambda i: case_run.case_output(i.run())
        .drop(*CLOCK)
        .withColumn("coded_pts", F.array_join("coded_pts", "|"))
    ),
    "run_record": _using(lambda i: case_run.run_record(i.run()).drop(*CLOCK)),
    "run_summary": _using(lambda i: case_run.run_summary(case_run.case_results(i.run()))),
    "scored_run": _using(_scored_run),
    "slice_run": _using(_slice_run),
    "validate_contract": _using(_validated),
    "validate_stages": _using(_validated_stages),
    "failed_cases": _using(_failed),
    "predicted_run": _using(_predicted_run),
    "active_versions": _using(_active),
    # streams
    "stream_audit": _using(_stream_audit),
    "stream_case_status": _using(_stream_status),
    "stream_intake": _using(_stream_intake),
}
