"""What a run shuffles and what a task holds."""

import os
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from safetylake.operators import evaluation, stages, surfaces
from safetylake.operators.postings import Postings
from safetylake.plans import case_run, catalog
from safetylake.plans.predict import checked, predict
from safetylake.session import stage_by_key, stage_table, tune
from safetylake.sources import reports as reports_csv
from safetylake.sources import star, tables
from safetylake.streaming import sink


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def reports(spark):
    told = "A 40-year-old male received X on 2024-01-02. Events: rash; itch. A nurse told."
    rows = [("1", told, "01022024"), ("1", told, "01022024"), ("2", "Nothing happened.", None), (None, "Rash.", "x"), ("3", None, "x")]
    return spark.createDataFrame(rows, "vaers_id string, narrative string, received_date string")


@pytest.fixture()
def ref(spark):
    dictionary = spark.createDataFrame([("Rash", "26.0"), ("Itch", "26.0")], "pt_term string, meddra_version string")
    products = spark.createDataFrame([("X",)], "vax_name string")
    scope = spark.createDataFrame([("X", True)], "vax_name string, in_scope boolean")
    return case_run.Reference(dictionary, products, scope).written()


def test_texts_are_dealt_once_and_not_their_words(reports, ref):
    read = case_run.read(reports, ref, "v")
    told = plan(read)
    assert told.count("Exchange hashpartitioning(run_id") == 1
    assert told.index("Generate posexplode") < told.index("Exchange hashpartitioning(run_id")  # the tree prints parents first
    found = {r["vaers_id"]: sorted(e["name"] for e in r["events"]) for r in read.collect()}
    assert found == {"1": ["Itch", "Rash"], "2": [], None: ["Rash"]}  # without a narrative nothing is read
    assert read.count() == 3


def test_coding_deals_no_case_again(reports, ref):
    runs = case_run.run_cases(reports, ref)
    assert "Exchange hashpartitioning(run_id" not in plan(runs)
    coded = {r["vaers_id"]: [c["meddra_pt"] for c in r["coding"]["result"]["coded"]] for r in runs.collect()}
    assert coded == {"1": ["Rash", "Itch"], "2": [], None: ["Rash"]}  # without a narrative nothing is read


def test_a_table_staged_by_key_keeps_all_rows_and_leaves_no_name(spark):
    rows = spark.range(100).selectExpr("cast(id % 7 as string) run_id", "id", "if(id = 3, null, id) x")
    kept = stage_by_key(rows, "kept", "run_id")
    assert sorted(map(str, kept.collect())) == sorted(map(str, rows.collect()))
    assert "Exchange" not in plan(kept.groupBy("run_id").count())
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("kept")]
    assert stage_by_key(rows.filter("false"), "kept", "run_id").count() == 0


def test_a_session_keeps_its_own_task_size(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    spark.conf.unset(key)
    assert tune(spark).conf.get(key) == "8m"
    spark.conf.set(key, "3m")
    assert tune(spark).conf.get(key) == "3m"
    spark.conf.set(key, before)


def test_scores_of_a_dense_block_are_held_a_few_at_a_time():
    n, d, k = 20000, 8, 5
    values = np.round(np.random.default_rng(1).normal(size=(n, d)), 1) + 0.05
    values[300:320] = values[7]  # ties beyond k
    slots = np.tile(np.arange(d), n)
    index = Postings(np.arange(n + 1) * d, slots, values.ravel())
    assert index.full
    unit = index.matrix[:250]
    tracemalloc.start()
    found = index.search_full([(np.arange(d), q) for q in unit], k, 9)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6
    scores = np.round(unit @ index.matrix.T, 9)
    best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    for (rows, values), b, s in zip(found, best, scores, strict=True):
        assert rows.tolist() == b.tolist() and np.allclose(values, s[b], atol=2e-9)


def test_reading_neither_sorts_nor_groups_matches(spark, reports, ref):
    told = plan(case_run.read(reports, ref, "v"))
    after_words = told[: told.index("Generate posexplode")]  # the tree prints parents first
    assert "Aggregate" not in after_words and "Sort" not in after_words


def test_a_large_vocabulary_is_dealt_and_gives_the_same(spark, reports, ref):
    def found(df):
        return sorted(map(str, df.select("vaers_id", "stated", "events", "products", "linked").collect()))

    small = found(case_run.read(reports, ref, "v"))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        assert found(case_run.read(reports, ref, "v")) == small
        assert "BroadcastHashJoin" not in plan(case_run.read(reports, ref, "v"))
    finally:
        spark.conf.set(key, before)


def test_reports_that_reach_beyond_a_batch_are_whole(spark, reports, ref):
    def found():
        return sorted(map(str, case_run.read(reports, ref, "v").collect()))

    whole = found()
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        assert found() == whole
    finally:
        spark.conf.set(key, before)


def test_outputs_are_judged_once(spark):
    inputs = spark.createDataFrame([("1", "a"), ("2", "b")], "run_id string, input_text string")
    sound = '{"valid":true,"missing_criteria":[],"seriousness_screen":{"serious":false,"criteria_flagged":[]},"priority":"standard","confidence":0.8}'
    good, bad = checked(predict(inputs, lambda texts: [sound if t == "a" else "{}" for t in texts]), "triage")
    assert "parse_json" not in plan(bad) and "MapInPandas" not in plan(good) + plan(bad)
    assert [r["run_id"] for r in good.collect()] == ["1"] and [r["run_id"] for r in bad.collect()] == ["2"]


def test_coding_neither_sorts_nor_groups_cases(reports, ref):
    runs = case_run.run_cases(reports, ref)
    assert "Aggregate" not in plan(runs) and "Sort" not in plan(runs)


def test_more_terms_than_a_broadcast_holds_code_the_same(spark, reports, ref):
    def found():
        return sorted(str((r["vaers_id"], r["extraction"], r["coding"])) for r in case_run.run_cases(reports, ref).collect())

    narrow = found()
    limit, batch = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = {key: spark.conf.get(key) for key in (limit, batch)}
    try:
        spark.conf.set(batch, "2")  # the events of a case reach beyond a batch
        assert found() == narrow
        spark.conf.set(limit, "-1")
        assert found() == narrow
        assert "BroadcastHashJoin" not in plan(case_run.run_cases(reports, ref))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_a_task_does_not_grow_with_the_input_when_partitions_stay(spark):
    tune(spark)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "32k")
    try:
        tasks = [spark.range(n).selectExpr("uuid() u").groupBy("u").count().rdd.getNumPartitions() for n in (10_000, 100_000)]
    finally:
        spark.conf.set(key, before)
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) < tasks[0] and 4 * tasks[0] < tasks[1]


def test_loading_sorts_no_lines_and_reads_a_quarantine_only_if_there_is_one(spark, tmp_path, monkeypatch):
    staged = {}

    def recorded(df, label):
        staged[label] = plan(df)
        return stage_table(df, label)

    monkeypatch.setattr(reports_csv, "stage_table", recorded)
    head = "VAERS_ID,SYMPTOM_TEXT\n"
    for name, lines in {"a": '1,"x\ny"\n2,z\n', "b": "3,x\n4,y,too,many\n"}.items():
        (tmp_path / f"{name}.csv").write_text(head + lines)
    load = lambda name: reports_csv.load_files(spark, {"raw_vaers_data": str(tmp_path / f"{name}.csv")}, str(tmp_path / f"raw-{name}"), "b")
    assert load("a") == {"raw_vaers_data": 2, "batch_id": "b"}
    assert "raw_vaers_data_quarantine" not in staged and "Sort" not in staged["files"]
    assert load("b") == {"raw_vaers_data": 1, "raw_vaers_data_quarantined": 1, "batch_id": "b"}
    kept_out = spark.read.parquet(str(tmp_path / "raw-b" / "raw_vaers_data_quarantine")).first()
    assert kept_out["first_field"] == "4" and kept_out["raw"] == "4,y,too,many"


def test_hashed_row_ids_are_stored_as_half_their_digits(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("cast(id as string) vaers_id", "sha2(cast(id as string), 256) _row_id")
    tables.append(rows, str(tmp_path), "raw_vaers_vax")
    assert sum(p.stat().st_size for p in (tmp_path / "raw_vaers_vax").glob("*.parquet")) < 20_000 * 48
    stored = tables.read_table(spark, str(tmp_path), "raw_vaers_vax").select(*rows.columns)
    assert stored.count() == 20_000 and stored.exceptAll(rows).count() == 0


def test_cases_pass_through_predictors_without_a_join(spark, reports, ref):
    def extractor(prompts):
        return ['{"case":{"patient":{"sex":"unknown"}},"confidence":%s}' % (7 if "Nothing" in p else 0.5) for p in prompts]

    done, failed = case_run.run_with_predictors(reports, ref, {"extraction": extractor}, ("triage", "extraction"))
    assert "Join" not in plan(done) and "Exchange" not in plan(done) and "Join" not in plan(failed)
    found = done.select("vaers_id", "triage.valid", "extraction.confidence", "received_date").collect()
    assert [tuple(r) for r in found] == [("1", True, 0.5, "01022024")]
    lost = {r["vaers_id"]: r["error"] for r in failed.collect()}
    assert set(lost) == {"2", None} and "confidence" in lost["2"]  # without an id there is no prompt
    assert not {"narrative", "input_text"} & set(done.columns)


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_coding_prompts_of_cases_are_the_rendered_ones(spark, threshold):
    cases = spark.createDataFrame(
        [("r1", "a", ["rash", "itch", "rash", None]), ("r2", "b", []), ("r3", "c", ["other"])], "run_id string, vaers_id string, verbatims array<string>"
    )
    found = spark.createDataFrame([("rash", ["Rash", "Chills"]), ("itch", []), ("itch", ["Itch"])], "verbatim string, candidates array<string>")
    event = "transform(verbatims, v -> named_struct('verbatim', v))"
    runs = cases.selectExpr("run_id", "vaers_id", f"named_struct('case', named_struct('events', {event})) extraction")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, threshold)
    try:
        given = {r["run_id"]: (r["vaers_id"], r["input_text"]) for r in stages.with_candidates(runs, found, ["vaers_id", "extraction"]).collect()}
        rendered = {r["run_id"]: r["prompt"] for r in stages.render_candidates(cases, found).collect()}
    finally:
        spark.conf.set(key, before)
    assert given == {"r1": ("a", rendered["r1"]), "r2": ("b", stages.CODE_HEADER), "r3": ("c", rendered["r3"])}


def test_batches_are_not_sized_row_by_row(spark):
    assert tune(spark).conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(2**31 - 1)


@pytest.fixture()
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


OUTPUTS = "run_id string, vaers_id string, pipeline_version string, coded_pts array<string>, seriousness string"


def test_scoring_deals_outputs_by_case_and_no_term_row(spark, no_broadcast):
    sure, unsure = '{"serious":true}', "{}"
    outputs = [
        ("r1", "1", "v", ["Rash", " rash", "Itch", None], sure), ("r1", "1", "v", ["Rash", " rash", "Itch", None], sure),
        ("r1", "1", "v", ["Itch"], unsure), ("r2", "1", "v", [], sure), ("r3", "2", "v", None, None), (None, "1", None, ["Pain"], sure), ("r4", None, "v", ["Rash"], sure),
    ]
    human = [("1", "RASH", 26.0), ("1", "rash ", 25.0), ("1", "Pain", 26.0), ("2", "Itch", 26.0), (None, "Rash", 26.0)]
    long = spark.createDataFrame(human, "vaers_id string, pt_term string, meddra_version double")
    facts = spark.createDataFrame([("1", True), ("2", False), (None, True)], "vaers_id string, serious boolean")
    scored = evaluation.eval_case(spark.createDataFrame(outputs, OUTPUTS), long, facts)
    assert not re.search(r"Exchange hashpartitioning\(run_id|Exchange hashpartitioning\(vaers_id#\d+, pt_term", plan(scored))
    found = scored.select("run_id", "vaers_id", "tp", "fp", "fn", "agent_serious", "gt_serious").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [("r1", "1", 2, 1, 1, True, True), ("r1", "1", 0, 1, 2, None, True), ("r2", "1", 0, 0, 2, True, True),
         ("r3", "2", 0, 0, 1, None, False), (None, "1", 1, 0, 1, True, True)], key=str)


def test_latest_runs_are_dealt_once_for_the_full_case(spark, no_broadcast):
    runs = spark.createDataFrame([("a", "1", 1), ("b", "1", 2), ("c", "2", 1), ("d", None, 1)], "run_id string, vaers_id string, day int")
    texts = [F.lit("x").alias(c) for c in ("pipeline_version", "extracted", "seriousness", "causality", "narrative")]
    made = F.timestamp_seconds("day").alias("created_at")
    runs = runs.select("*", made, *texts, F.array().cast("array<string>").alias("coded_pts"), F.lit(0.5).alias("overall_confidence"), F.lit(True).alias("hitl_required"))
    scores = "vaers_id string, run_id string, f1 double, precision double, recall double, seriousness_match boolean"
    scored = spark.createDataFrame([("1", "a", 0.1, 0.1, 0.1, True), ("1", "b", 0.2, 0.2, 0.2, False), ("2", "x", 0.3, 0.3, 0.3, True)], scores)
    facts = spark.createDataFrame([("1", "t"), ("1", "t"), ("2", "u"), ("3", "w"), (None, "n")], "vaers_id string, symptom_text string")
    facts = facts.select("*", F.lit(1.0).alias("age_yrs"), F.lit("M").alias("sex"), F.lit(True).alias("serious"), F.lit(2).alias("n_coded_pts"))
    full = surfaces.case_full(facts, runs, scored)
    assert not re.search(r"Exchange hashpartitioning\(vaers_id#\d+, run_id", plan(full))
    found = full.select("vaers_id", "run_id", "coding_f1").collect()
    assert sorted(map(tuple, found), key=str) == [("1", "b", 0.2), ("1", "b", 0.2), ("2", "c", None), ("3", None, None), (None, None, None)]


def test_both_runs_of_an_order_are_made_of_one_row(spark, no_broadcast):
    made = star.outputs(spark, "/root/testdata/sf0.001")
    assert "v#" not in "".join(re.findall(r"Exchange hashpartitioning\([^)]*\)", plan(made)))
    assert made.count() == 2 * star.table(spark, "/root/testdata/sf0.001", "orders").count()


def test_only_records_of_several_lines_are_put_together(spark, tmp_path, no_broadcast):
    file = tmp_path / "a.csv"
    file.write_text('ID,TEXT\n1,"one\ntwo\n\nthree"\n2,plain\n3,"a ""b"", c"\n4,"x\n5,y"\n6,last\n', encoding="latin-1")
    rows, bad = reports_csv.read_report_csv(spark, str(file))
    found = sorted((r["id"], r["text"]) for r in rows.collect())
    assert found == [("1", "one\ntwo\n\nthree"), ("2", "plain"), ("3", 'a "b", c'), ("4", "x\n5,y"), ("6", "last")]
    assert bad.count() == 0
    assert "lead(starts" in plan(rows)  # a line that a record's start follows is a record of its own


def test_report_files_of_the_queries_are_packed(spark):
    i = catalog.Inputs(spark, "/root/testdata/sf0.001")
    path = catalog._write_csv(i, "vax")
    assert all(f.endswith(".csv.gz") for f in os.listdir(path) if f.startswith("part"))
    rows, _ = reports_csv.read_report_csv(spark, path)
    names = ["vaers_id", "vax_type", "vax_manu", "vax_lot", "vax_dose_series", "vax_name"]
    assert sorted(map(tuple, rows.select(names).collect())) == sorted(map(tuple, i.vax.select(names).collect()))


def test_stream_tables_and_stages_are_stored_with_zstd(spark, tmp_path):
    key = "spark.sql.parquet.compression.codec"
    before = spark.conf.get(key, None)
    spark.conf.unset(key)
    tune(spark)
    rows = spark.createDataFrame([("r", "1", "v")], "run_id string, vaers_id string, pipeline_version string")
    sink.write_batch(rows, str(tmp_path), "agt_run", 0)
    stage_table(rows, "kept").write.parquet(str(tmp_path / "landing"))
    assert spark.conf.get(key) == "zstd"
    files = list(tmp_path.rglob("part-*.parquet"))
    assert len(files) >= 2 and all(".zstd." in f.name for f in files)
    if before:
        spark.conf.set(key, before)
