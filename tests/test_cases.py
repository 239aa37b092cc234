"""Stages, grounding, contracts and whole runs on small hand-made reports."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from safetylake import schemas as S
from safetylake.operators import contracts, grounding, mentions, stages
from safetylake.operators.mentions import vocabulary
from safetylake.plans import case_run
from safetylake.plans.predict import checked, predict

REPORTS = [
    ("1", "A 45 year old woman received FLU (X) on 2024-03-01. Onset 2024-03-03. She had acute chest pain; chills. "
          "The nurse reported she was hospitalised and had a life-threatening state. History: asthma, gout.", "03052024"),
    ("2", "No details given.", None),
    ("3", "The patient, a 30 yo man, got MMR on 3/1/2024; onset 02/27/2024. Rash. Allergies: eggs.", "03052024"),
    ("4", "A male had chest. Pain followed 4 days after FLU (X).", "03052024"),
]


@pytest.fixture(scope="module")
def ref(spark):
    dictionary = spark.createDataFrame(
        [("Acute chest pain", "24.0"), ("Chest pain", "24.0"), ("Chills", "24.0"), ("Rash", "24.0"), ("Pain", "24.0")],
        "pt_term string, meddra_version string",
    )
    products = spark.createDataFrame([("FLU (X)",), ("MMR",)], "vax_name string")
    scope = spark.createDataFrame([("FLU (X)", True)], "vax_name string, in_scope boolean")
    return case_run.Reference(dictionary, products, scope)


@pytest.fixture(scope="module")
def reports(spark):
    return spark.createDataFrame(REPORTS, "vaers_id string, narrative string, received_date string")


@pytest.fixture(scope="module")
def runs(reports, ref):
    return case_run.store(case_run.run_cases(reports, ref))


def by_case(df):
    return {r["vaers_id"]: r for r in df.collect()}


def test_extraction_states_only_what_is_written(runs):
    got = by_case(runs)
    case = got["1"]["extraction"]["case"]
    assert (case["patient"]["age_years"], case["patient"]["sex"]) == (45.0, "female")
    assert [e["verbatim"] for e in case["events"]] == ["acute chest pain", "chest pain", "pain", "chills"]
    assert [(p["name"], p["role"]) for p in case["products"]] == [("FLU (X)", "suspect")]
    assert (case["vaccination_date"], case["onset_date"], case["days_to_onset"]) == ("2024-03-01", "2024-03-03", 2)
    assert case["medical_history"] == ["asthma", "gout"]
    empty = got["2"]["extraction"]["case"]
    assert empty["patient"]["age_years"] is None and empty["patient"]["sex"] == "unknown"
    assert empty["events"] == [] and empty["days_to_onset"] is None
    third = got["3"]["extraction"]["case"]
    assert (third["vaccination_date"], third["onset_date"], third["days_to_onset"]) == ("2024-03-01", "2024-02-27", -3)
    assert third["allergies"] == ["eggs"] and third["products"][0]["role"] == "concomitant"
    # "chest. Pain" spans two sentences and is not chest pain; the stated days are used
    fourth = got["4"]["extraction"]["case"]
    assert [e["verbatim"] for e in fourth["events"]] == ["Pain"] and fourth["days_to_onset"] == 4


def test_triage_and_assessment(runs):
    got = by_case(runs)
    assert got["1"]["triage"]["valid"] and got["1"]["triage"]["priority"] == "expedited"
    assert got["1"]["triage"]["seriousness_screen"]["criteria_flagged"] == ["life_threatening", "hospitalization"]
    assert got["2"]["triage"]["missing_criteria"] == S.VALIDITY
    assert got["2"]["triage"]["confidence"] == 0.2
    categories = {k: r["assessment"]["causality"]["category"] for k, r in got.items()}
    assert categories == {"1": "probable", "2": "unassessable", "3": "unlikely", "4": "possible"}


def test_qc_routes_to_review(runs):
    got = by_case(runs)
    flags = [(f["type"], f["severity"]) for f in got["3"]["narrative_qc"]["qc_flags"]]
    assert flags == [("temporal_anomaly", "error")]
    assert got["3"]["narrative_qc"]["hitl_recommended"] and got["3"]["hitl_required"]
    assert got["2"]["narrative_qc"]["completeness"]["gaps"] == [
        "age", "sex", "product", "event", "vaccination_date", "onset_date",
    ]
    assert not got["1"]["hitl_required"]
    for r in got.values():
        parts = [r["triage"], r["extraction"], r["coding"], r["assessment"]]
        assert r["overall_confidence"] == min([p["confidence"] for p in parts] + [r["narrative_qc"]["overall_confidence"]])


def test_steps_are_numbered_over_present_stages(reports, ref, runs):
    steps = sorted(case_run.step_events(runs).filter("vaers_id = '1'").collect(), key=lambda r: r["seq"])
    assert [r["agent_name"] for r in steps] == S.STAGES and [r["seq"] for r in steps] == [1, 2, 3, 4, 5]
    assert len({r["event_id"] for r in steps}) == 5
    for r in steps:
        assert set(json.loads(r["output"])) == set(contracts.CONTRACTS[r["agent_name"]].fields)
    only = case_run.run_cases(reports, ref, ("extraction",), S.PIPELINE_VERSION["extraction"])
    assert case_run.step_events(only).count() == 4
    out = by_case(case_run.case_output(only))["1"]
    assert out["seriousness"] is None and out["coded_pts"] == [] and out["coded_detail"] is None
    some = case_run.run_cases(reports, ref, ("assessment", "extraction"))
    assert {r["seq"] for r in case_run.step_events(some).collect()} == {1, 2}
    record = by_case(case_run.run_record(some))["1"]
    assert json.loads(record["model_config"]).keys() == {"extraction_model", "assessment_model"}


def test_stage_outputs_keep_their_contracts(runs):
    steps = case_run.step_events(runs)
    for stage in S.STAGES:
        judged = contracts.validate(steps.filter(F.col("agent_name") == stage), "output", stage)
        assert judged.filter(~F.col("valid")).count() == 0


def test_run_ids_repeat_and_copies_make_one_run(reports, ref, runs):
    twice = case_run.run_cases(reports.unionAll(reports).unionAll(reports), ref)
    assert twice.count() == 4
    assert {r["run_id"] for r in twice.collect()} == {r["run_id"] for r in runs.collect()}


def test_coding_levels(spark, ref):
    verbatims = spark.createDataFrame(
        [("ACUTE  chest pain",), ("acute chest pains",), ("chils",), ("nothing like it",), (" ",)], "verbatim string"
    )
    got = {r["verbatim"]: r for r in stages.code_terms(verbatims, ref.dictionary).collect()}
    assert got["ACUTE  chest pain"]["meddra_pt"] == "Acute chest pain" and got["ACUTE  chest pain"]["confidence"] == 1.0
    assert got["acute chest pains"]["meddra_pt"] == "Acute chest pain"
    assert got["chils"]["meddra_pt"] == "Chills" and got["chils"]["requires_review"]
    assert got["nothing like it"]["meddra_pt"] is None and got[" "]["meddra_pt"] is None


def test_grounding_equals_brute_force_in_any_block_size(spark):
    rng = np.random.default_rng(3)
    terms = {f"t{i:02d}": rng.normal(size=8) for i in range(40)}
    terms["zero"] = np.zeros(8)
    queries = {f"q{i}": rng.normal(size=8) for i in range(6)}
    q = spark.createDataFrame([(k, v.tolist()) for k, v in queries.items()], "verbatim string, vector array<double>")
    t = spark.createDataFrame([(k, v.tolist()) for k, v in terms.items()], "pt_term string, vector array<double>")
    unit = lambda v: v / (np.linalg.norm(v) + 1e-9)
    expected = {
        k: sorted(terms, key=lambda n: (-float(np.round(unit(v) @ unit(terms[n]), 9)), n))[:5] for k, v in queries.items()
    }
    for block_bytes in (1 << 20, 1000):
        tops = grounding.ground_topk(q, t, 5, block_bytes)
        got = {r["verbatim"]: r["candidates"] for r in grounding.candidate_lists(q, tops).collect()}
        assert got == expected
    none = grounding.ground_topk(q, t.limit(0))
    assert all(r["candidates"] == [] for r in grounding.candidate_lists(q, none).collect())
    assert all(r["candidates"] == [] for r in grounding.ground_null(q).collect())


def test_long_terms_are_found(spark, ref):
    term = "one two three four five six seven eight nine"
    dictionary = ref.dictionary.unionAll(spark.createDataFrame([(term, "1")], ref.dictionary.schema))
    assert vocabulary(dictionary, ref.products, ref.scope).filter(F.col("phrase") == term.upper()).count() == 1
    report = spark.createDataFrame([("9", f"So {term} was seen.", "x")], "vaers_id string, narrative string, received_date string")
    long_ref = case_run.Reference(dictionary, ref.products, ref.scope)
    row = case_run.run_cases(report, long_ref, ("extraction",)).first()
    assert [e["verbatim"] for e in row["extraction"]["case"]["events"]] == [term]


def errors(spark, contract, document):
    text = document if isinstance(document, str) else json.dumps(document)
    frame = spark.createDataFrame([(text,)], "output string")
    return contracts.validate(frame, "output", contract).first()["errors"]


def test_contracts(spark):
    case = {"patient": {"sex": "male", "age_years": 30}, "events": [{"verbatim": "fever"}]}
    assert errors(spark, "extraction", {"case": case, "confidence": 0.9}) == []
    assert errors(spark, "extraction", {"case": case, "confidence": 1.7}) == ["confidence: out of range"]
    assert errors(spark, "extraction", {"case": {**case, "extra": 1}, "confidence": 0.9}) == ["case.extra: unknown field"]
    assert errors(spark, "extraction", {"case": {"patient": {"sex": "x"}}, "confidence": None}) == [
        "case.patient.sex: not in list", "confidence: null",
    ]
    assert errors(spark, "extraction", {"case": {**case, "events": "none"}, "confidence": 0.9}) == ["case.events: not a list"]
    assert errors(spark, "extraction", {"case": {**case, "days_to_onset": 1.5}, "confidence": "0.9"}) == [
        "case.days_to_onset: not whole"
    ]
    causality = {"method": "WHO-UMC", "category": "definitely", "rationale": "r"}
    assert errors(spark, "causality", causality) == ["category: not in list"]
    assert errors(spark, "causality", "no json") == ["not JSON"]
    assert errors(spark, "causality", "[]") == ["not an object"]
    assert errors(spark, "triage", {"valid": True}) == [
        "confidence: missing", "priority: missing", "seriousness_screen: missing",
    ]
    coded = {"verbatim": "fever", "meddra_pt": 5, "confidence": 0.9}
    assert errors(spark, "coding", {"result": {"coded": [coded]}, "confidence": 1}) == ["result.coded[].meddra_pt: not text"]


def test_predictor_failures_stay_with_their_rows(spark):
    def predictor(texts):
        def one(text):
            if text == "bad":
                raise ValueError("cannot read\nsecond line")
            return json.dumps({"result": {"uncoded": [text]}, "confidence": 2 if text == "wrong" else 0.9})

        return [one(t) for t in texts]

    inputs = spark.createDataFrame([(str(i), t) for i, t in enumerate(["a", "bad", "wrong", "b"])], "run_id string, input_text string")
    good, bad = checked(predict(inputs, predictor), "coding")
    assert sorted(r["run_id"] for r in good.collect()) == ["0", "3"]
    assert good.first()["coding"]["result"]["coded"] == []
    assert sorted((r["run_id"], r["error"]) for r in bad.collect()) == [
        ("1", "cannot read\nsecond line"), ("2", "contract: confidence: out of range"),
    ]


def test_run_with_predictors(reports, ref):
    def assessor(texts):
        def one(text):
            if "None" in text.splitlines()[2]:
                raise ValueError("no patient")
            return json.dumps({
                "seriousness": {"serious": True},
                "causality": {"method": "Naranjo", "category": "certain", "rationale": text.splitlines()[0]},
                "confidence": 0.4,
            })

        return [one(t) for t in texts]

    done, failed = case_run.run_with_predictors(reports, ref, {"assessment": assessor})
    got = by_case(done)
    assert set(got) == {"1", "3"}
    assert got["1"]["overall_confidence"] == 0.4 and got["1"]["hitl_required"]
    assert got["1"]["assessment"]["causality"]["rationale"] == "Case 1, to be assessed:"
    assert {(r["vaers_id"], r["error"]) for r in failed.collect()} == {("2", "no patient"), ("4", "no patient")}
    assert case_run.failed_runs(failed, "v").count() == 2
    n_failed = case_run.failed_runs(failed, "v").count()
    summary = case_run.run_summary(case_run.case_results(done), n_failed).first()
    assert (summary["ok"], summary["hitl"], summary["serious"], summary["failed"]) == (2, 2, 2, 2)


def test_predicted_extraction_feeds_later_stages(reports, ref):
    def extractor(texts):
        return [
            json.dumps({"case": {"patient": {"sex": "male"}, "events": [{"verbatim": "rash"}, {"verbatim": "qqq"}]}, "confidence": 0.95})
            for _ in texts
        ]

    done, failed = case_run.run_with_predictors(reports, ref, {"extraction": extractor}, ("extraction", "coding"))
    row = by_case(done)["1"]
    assert [c["meddra_pt"] for c in row["coding"]["result"]["coded"]] == ["Rash"]
    assert row["coding"]["result"]["uncoded"] == ["qqq"] and row["hitl_required"]
    assert failed.count() == 0


def test_rendered_candidates(spark):
    cases = spark.createDataFrame([("r", ["b", "a", "b"])], "run_id string, verbatims array<string>")
    found = spark.createDataFrame([("b", ["X", "Y"]), ("a", [])], "verbatim string, candidates array<string>")
    assert stages.render_candidates(cases, found).first()["prompt"] == (
        "Code each event below.\n\n1. Event: b\n   Candidate PTs: X; Y\n"
        "2. Event: a\n   Candidate PTs: (no candidates retrieved)\n3. Event: b\n   Candidate PTs: X; Y"
    )


@pytest.mark.parametrize(
    ("told", "age"),
    [
        ("A 45-year-old man", 45.0), ("A 1.5-year-old girl", 1.5), ("diabetes for 10 years. A 45 y.o. man", 45.0),
        ("A 6-month-old boy", 0.5), ("A 3 week old girl", 0.0577), ("aged 71, male", 71.0), ("He smoked for 20 years", None),
        ("a 30 yo man", 30.0), ("an 81 y/o woman", 81.0),
    ],
)
def test_stated_ages(spark, told, age):
    row = spark.createDataFrame([(told,)], "narrative string").select(
        mentions.stated_age(mentions.stated_texts(F.col("narrative"), F.lower("narrative"))).alias("age")
    )
    assert row.first()["age"] == age


def test_long_day_counts(spark):
    row = spark.createDataFrame([("12000 days after the dose",)], "narrative string").select(
        mentions.stated_texts(F.col("narrative"), F.lower("narrative"))["days"].alias("days")
    )
    assert row.first()["days"] == "12000"


def test_stages_after_predictors_read_their_outputs(spark, reports, ref):
    seen = str(spark.sparkContext.applicationId)

    def triage(texts):
        screen = {"serious": True, "criteria_flagged": ["death"]}
        return [json.dumps({"valid": True, "missing_criteria": [], "seriousness_screen": screen, "priority": "expedited", "confidence": 0.9, "rationale": seen}) for _ in texts]

    def coder(texts):
        return [json.dumps({"result": {"coded": [], "uncoded": [t]}, "confidence": 0.9}) for t in texts]

    done, _ = case_run.run_with_predictors(reports, ref, {"triage": triage, "coding": coder})
    rows = {r["vaers_id"]: r for r in done.collect()}
    assert all(r["assessment"]["seriousness"]["serious"] for r in rows.values())
    prompts = [r["coding"]["result"]["uncoded"][0] for r in rows.values()]
    assert any("Candidate PTs: " in p for p in prompts) and len(rows) == reports.count()
    steps = case_run.step_events(done, {"triage": "mine"}).collect()
    assert {(s["agent_name"], s["model"]) for s in steps if s["agent_name"] in ("triage", "coding")} == {("triage", "mine"), ("coding", case_run.RULES_MODEL)}


@pytest.mark.parametrize(
    ("told", "left"),
    [
        ("No hospitalization, it was not fatal.", "| , it was | ."), ("She denied headache but felt chills.", "She | | but felt chills."),
        ("Has not recovered from rash.", "Has | recovered from rash."), ("A nodule, noted.", "A nodule, noted."),
        ("Never had fever or chills or any rash today", "| or any rash today"), (None, None), ("", ""),
    ],
)
def test_denied_words_are_not_read(spark, told, left):
    row = spark.createDataFrame([(told,)], "t string").select(mentions.affirmed(F.col("t")).alias("t")).first()
    assert (row["t"] and " ".join(row["t"].split())) == left


def test_denied_criteria_and_events(spark, ref):
    told = "A 40-year-old man received X. No hospitalization; the outcome was not fatal. Denied rash."
    reports = spark.createDataFrame([("1", told, None)], "vaers_id string, narrative string, received_date string")
    row = case_run.run_cases(reports, ref).first()
    assert row["triage"]["seriousness_screen"]["criteria_flagged"] == []
    assert row["extraction"]["case"]["events"] == []


def test_predictors_tell_what_they_used(spark):
    def counted(texts):
        return [('{"result":{"coded":[],"uncoded":[]},"confidence":1}', len(t), 3) for t in texts]

    inputs = spark.createDataFrame([("r", "four")], "run_id string, input_text string")
    good, _ = checked(predict(inputs, counted), "coding")
    used = good.first()["usage_coding"]
    assert (used["input_tokens"], used["output_tokens"]) == (4, 3) and used["latency_ms"] >= 0
