"""Reference tables, ground truth, signals and review tables on small hand-made rows."""

from pyspark.sql import functions as F

from safetylake.operators import evaluation, reference, signals, surfaces, truth

VAX = "vaers_id string, vax_type string, vax_manu string, vax_name string"
FLAGS = "vaers_id string, died string, l_threat string, hospital string, disable string, birth_defect string"


def test_scope_is_incremental_and_null_safe(spark, rows):
    vax = spark.createDataFrame(
        [("1", "C", "m2", "A"), ("2", "C", "m1", "A"), ("3", "C", "m1", "B"), ("4", "D", "m1", "E")], VAX
    )
    existing = spark.createDataFrame([("A",), (None,)], "vax_name string")
    assert rows(reference.product_scope(vax, "C"), "vax_name", "vax_manu") == [("A", "m1"), ("B", "m1")]
    assert rows(reference.product_scope(vax, "C", "m1", existing), "vax_name") == [("B",)]
    unnamed = vax.unionAll(spark.createDataFrame([("9", "C", "m1", None)], VAX))
    first = reference.product_scope(unnamed, "C")
    assert first.count() == 3 and reference.product_scope(unnamed, "C", None, first).count() == 0


def test_dictionary_keeps_raw_terms_and_skips_known(spark, rows):
    long = spark.createDataFrame(
        [("1", "Pyrexia", 24.0), ("1", "pyrexia", 25.0), ("1", "Pyrexia", 23.0), ("2", "Chills", 24.0), ("3", "Rash", 24.0)],
        "vaers_id string, pt_term string, meddra_version double",
    )
    cases = spark.createDataFrame([("1",), ("2",)], "vaers_id string")
    known = spark.createDataFrame([("Chills",)], "pt_term string")
    got = rows(reference.pt_dictionary(long, cases, known), "pt_term", "occurrence_count", "meddra_version")
    assert got == [("Pyrexia", 2, "23.0"), ("pyrexia", 1, "25.0")]


def test_symptom_slots(spark, rows):
    wide = spark.createDataFrame(
        [("1", "A", 1.0, " ", 1.0, None, 1.0, "\t", 2.0, "B\n", None)],
        "vaers_id string, symptom1 string, symptomversion1 double, symptom2 string, symptomversion2 double, "
        "symptom3 string, symptomversion3 double, symptom4 string, symptomversion4 double, symptom5 string, "
        "symptomversion5 double",
    )
    long = truth.symptoms_long(wide)
    assert rows(long, "pt_term") == [("A",), ("B\n",)]
    assert rows(truth.gt_pt(long), "pt_term") == [("A",), ("B",)]


def test_serious_is_three_valued(spark):
    raw = spark.createDataFrame(
        [("1", "Y", None, None, None, None), ("2", "N", None, "N", "N", "N"), ("3", "N", "N", "N", "N", "N")], FLAGS
    )
    got = {r["vaers_id"]: r["serious"] for r in truth.gt_seriousness(raw).collect()}
    assert got == {"1": True, "2": None, "3": False}
    fixed = {r["vaers_id"]: r["serious"] for r in truth.gt_seriousness(raw, null_as_false=True).collect()}
    assert fixed["2"] is False


def test_dates_parse_or_are_null(spark):
    df = spark.createDataFrame([("01312024",), ("02302024",), ("1/31/2024",), (None,)], "d string")
    got = [r[0] for r in df.select(truth.parse_date("d")).collect()]
    assert [str(d) if d else None for d in got] == ["2024-01-31", None, None, None]
    both = df.select(truth.parse_date("d", ("MMddyyyy", "M/d/yyyy"))).collect()
    assert str(both[2][0]) == "2024-01-31"


def test_latest_batch_undoes_reloads(spark, rows):
    raw = spark.sql(
        "select * from values ('1','a',timestamp'2024-01-01','b1'), ('1','b',timestamp'2024-01-02','b2'), "
        "('2','c',timestamp'2024-01-01','b1') as t(vaers_id, state, _ingested_at, _load_batch_id)"
    )
    assert rows(truth.latest_batch(raw), "vaers_id", "state") == [("1", "b"), ("2", "c")]


def outputs(spark, data):
    return spark.createDataFrame(data, "vaers_id string, coded_pts array<string>")


def test_signal_cells_and_ratios(spark):
    data = [(str(i), ["Rash"] if i < 4 or i == 10 else [" rash ", None, " "] if i == 11 else []) for i in range(20)]
    scope = spark.createDataFrame([(str(i),) for i in range(8)], "vaers_id string")
    frame = outputs(spark, data)
    exposure = signals.case_exposure(frame, scope)
    got = signals.signal_metrics(signals.signal_cells(signals.case_event(frame), exposure)).first()
    assert (got["event_pt"], got["a"], got["b"], got["c"], got["d"], got["n_total"]) == ("RASH", 4, 4, 2, 10, 20)
    assert (got["prr"], got["ror"], got["signal_flag"]) == (3.0, 5.0, True)


def test_signal_without_controls_is_null_not_an_error(spark):
    frame = outputs(spark, [(str(i), ["Rash"]) for i in range(5)])
    scope = spark.createDataFrame([(str(i),) for i in range(5)], "vaers_id string")
    exposure = signals.case_exposure(frame, scope)
    metrics = signals.signal_metrics(signals.signal_cells(signals.case_event(frame), exposure))
    row = metrics.first()
    assert (row["prr"], row["ror"], row["signal_flag"]) == (None, None, None)
    assert signals.signal_rows(metrics).first()["signal_flag"] is False


def test_partial_signal_row_gets_defaults(spark):
    part = spark.createDataFrame([("Pyrexia", 2.1, "x")], "event_pt string, prr double, unknown_col string")
    row = signals.signal_rows(part).first().asDict()
    assert row == {
        "event_pt": "Pyrexia", "a": 0, "b": 0, "c": 0, "d": 0, "n_total": 0, "prr": 2.1, "ror": None,
        "signal_flag": False,
    }


def metrics_of(spark, n=130):
    data = [(f"T{i:03d}", i, 1, 1, 1, 9, float(i), None, i % 2 == 0) for i in range(n)]
    return spark.createDataFrame(
        data, "event_pt string, a long, b long, c long, d long, n_total long, prr double, ror double, signal_flag boolean"
    )


def test_signal_query_limits_and_fallback(spark):
    metrics = metrics_of(spark)
    answer, caveats = signals.signal_query(metrics)
    assert answer.count() == 25 and not caveats and answer.first()["event_pt"] == "T129"
    large, caveats = signals.signal_query(metrics, limit=1000)
    assert large.count() == 130 and not caveats
    refused, caveats = signals.signal_query(metrics, limit=120, max_limit=100)
    assert refused.count() == 25 and "limit 120 is above 100" in caveats[0]
    flagged, _ = signals.signal_query(metrics, min_count=100, flagged_only=True, columns=["event_pt", "a"])
    assert flagged.columns == ["event_pt", "a"] and flagged.count() == 15
    fallback, caveats = signals.signal_query(metrics, order_by="speed", limit=3)
    assert fallback.count() == 25 and "unknown metric" in caveats[0]


def test_requests_are_screened(spark):
    data = [
        ("signals", "select", "prr", 1, 10), ("signals", "select", "prr", 1, None), ("signals", "select", "prr", 1, 500),
        ("signals", "drop", "prr", 1, 1), ("signals", "delete", "prr", 1, 1), ("cases", "select", "prr", 1, 1),
        ("signals", "select", "prr", 2, 1), (None, "select", "prr", 1, 1),
    ]
    requests = spark.createDataFrame(data, "source string, operation string, metric string, n_statements int, row_limit int")
    got = [(r["ok"], r["safe_limit"]) for r in signals.screen_requests(requests, ["Signals"]).collect()]
    assert got == [(True, 10), (True, 100), (True, 500)] + [(False, None)] * 5


def test_review_queue_and_latest_run(spark, rows):
    runs = spark.sql(
        "select * from values ('1','r1',timestamp'2024-01-01',true,0.5D), ('1','r2',timestamp'2024-01-01',true,0.4D), "
        "('2','r3',timestamp'2024-01-01',false,0.9D), ('3','r4',timestamp'2024-01-01',true,0.3D), "
        "('4','r5',timestamp'2024-01-01',true,0.2D) as t(vaers_id, run_id, created_at, hitl_required, overall_confidence)"
    )
    runs = runs.selectExpr("*", "'v' pipeline_version", "'n' narrative", "array('a') coded_pts", "'{}' seriousness")
    reviews = spark.createDataFrame([("r4", "approve"), ("r5", "edit")], "run_id string, action string")
    assert rows(surfaces.latest_run(runs), "run_id") == [("r2",), ("r3",), ("r4",), ("r5",)]
    queue = [r["run_id"] for r in surfaces.review_queue(runs, reviews).collect()]
    assert queue == ["r5", "r2"]


RUNS = "run_id string, vaers_id string, pipeline_version string, coded_pts array<string>, seriousness string"


def test_repeated_runs_keep_sound_scores(spark, rows):
    same = ("r1", "1", "v", ["Pyrexia", "Chills", "Rash"], '{"serious": true}')
    again = ("r1", "1", "v", ["Pyrexia"], '{"serious": false}')
    outputs = spark.createDataFrame([same, same, again, ("r2", "2", "v", [], None)], RUNS)
    long = spark.createDataFrame([("1", "Pyrexia"), ("1", "Chills"), ("1", "Cough"), ("2", "Rash")], "vaers_id string, pt_term string")
    facts = spark.createDataFrame([("1", True), ("2", False)], "vaers_id string, serious boolean")
    found = evaluation.eval_case(outputs, long.withColumn("pt_term", F.upper("pt_term")), facts)
    assert rows(found, "run_id", "tp", "fp", "fn", "seriousness_match") == [
        ("r1", 1, 0, 2, False), ("r1", 2, 1, 1, True), ("r2", 0, 0, 1, None),
    ]
    assert found.filter("fn < 0 or recall > 1").count() == 0


def test_newest_truth_counts(spark):
    reports = spark.createDataFrame(
        [("1", "Y", "M", "b1", 1), ("1", "N", "F", "b2", 2)], "vaers_id string, died string, sex string, _load_batch_id string, _ingested_at long"
    ).select("*", *[F.lit("N").alias(c) for c in ("l_threat", "hospital", "disable", "birth_defect")])
    facts = truth.gt_seriousness(reports, keep=truth.LOAD_STAMPS)
    assert truth.one_per_case(facts, "serious").first()["serious"] is False
    assert truth.one_per_case(reports, "sex").first()["sex"] == "F"
    assert truth.one_per_case(reports.select("vaers_id", "sex"), "sex").first()["sex"] == "M"
