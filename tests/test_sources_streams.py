"""Report files, tables and streams."""

import datetime
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from safetylake import session
from safetylake.operators import surfaces
from safetylake.plans import case_run, predict
from safetylake.sources import reports, tables
from safetylake.streaming import jobs, sink

HEADER = "VAERS_ID, VAX_TYPE ,VAX_MANU,VAX_NAME,SHOE_SIZE\n"


def write(folder, name, text):
    path = folder / name
    path.write_bytes(text.encode("latin-1"))
    return str(path)


def test_csv_quirks(spark, tmp_path, rows):
    body = (
        '1,COVID19,Méru,"NA",9\n'
        '2,,"",ok,9\n'
        '3,"line one\nline two, with comma",m,"say ""hi""",9\n'
        "4,short\n"
        "5,a,b,c,d,too,long\n"
        '6,a,b,c,"d, e","f"\n'
    )
    good, bad = reports.read_report_csv(spark, write(tmp_path, "VAX.csv", HEADER + body))
    assert good.columns[:5] == ["vaers_id", "vax_type", "vax_manu", "vax_name", "shoe_size"]
    got = {r["vaers_id"]: r for r in good.collect()}
    assert set(got) == {"1", "2", "3", "4"}
    assert (got["1"]["vax_manu"], got["1"]["vax_name"]) == ("Méru", "NA")
    assert (got["2"]["vax_type"], got["2"]["vax_manu"]) == (None, None)
    assert got["3"]["vax_type"] == "line one\nline two, with comma" and got["3"]["vax_name"] == 'say "hi"'
    assert got["4"]["vax_type"] == "short" and got["4"]["vax_name"] is None
    assert sorted(r["raw"][0] for r in bad.collect()) == ["5", "6"]
    assert good.count() == 4 and bad.count() == 2
    assert sorted(r["vaers_id"] for r in good.select("vaers_id").collect()) == ["1", "2", "3", "4"]


def test_csv_stray_quotes(spark, tmp_path):
    body = (
        '1,6" wound,M,a,9\n'
        '2,plain,"two\nlines, 6"" each",b,9\n'
        '3,x"y"z,"closed" after,c,9\n'
        '4,"6"" wound\n",q,d",9\n'
        '5,"",",",""",x",9\n'
        "6,last,m,n,9\n"
    )
    expected = {
        "1": ('6" wound', "M", "a"), "2": ("plain", 'two\nlines, 6" each', "b"), "4": ('6" wound\n', "q", 'd"'),
        "5": (None, ",", '",x'), "6": ("last", "m", "n"),
    }
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("1g", "40", "17"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        good, bad = reports.read_report_csv(spark, write(tmp_path, "VAX.csv", HEADER + body))
        got = {r["vaers_id"]: (r["vax_type"], r["vax_manu"], r["vax_name"]) for r in good.collect()}
        assert set(got) == set("123456") and bad.count() == 0
        assert {k: got[k] for k in expected} == expected
        assert got["3"][0] == 'x"y"z'
    # the same rows without line breaks are read line by line
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    flat, _ = reports.read_report_csv(spark, write(tmp_path, "VAX.csv", HEADER + '1,6" wound,M,a,9\n6,last,m,n,9\n'))
    assert {r["vaers_id"]: r["vax_type"] for r in flat.collect()} == {"1": '6" wound', "6": "last"}


def test_csv_files_with_their_own_headers(spark, tmp_path):
    paths = [write(tmp_path, "a.csv", "id,p\n1,x\n"), write(tmp_path, "b.csv", "p,id,q\ny,2,z\n")]
    good, _ = reports.read_report_csv(spark, paths)
    assert sorted((r["id"], r["p"], r["q"]) for r in good.collect()) == [("1", "x", None), ("2", "y", "z")]


def test_csv_split_inside_quoted_fields(spark, tmp_path):
    rng = random.Random(5)
    words = ["plain", "two\nlines", 'a "quoted" word', "x,y", "\n\n", "", "é" * 20, '"', 'end"\n']
    table = [[str(i)] + [rng.choice(words) for _ in range(3)] for i in range(400)]
    def field(value):
        return '"%s"' % value.replace('"', '""') if any(c in value for c in '",\n') else value
    files = {"a.csv": table[:250], "b.csv": [[r[0], "plain", "", "x"] for r in table[250:]]}
    for name, part in files.items():
        write(tmp_path, name, "id,p,q,r\n" + "".join(",".join(map(field, r)) + "\n" for r in part))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    try:
        good, bad = reports.read_report_csv(spark, str(tmp_path))
        got = sorted([[r[c] for c in ("id", "p", "q", "r")] for r in good.collect()], key=lambda r: int(r[0]))
        assert bad.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = [[v or None for v in r] for part in files.values() for r in part]
    assert got == expected


def test_conform_keeps_known_columns_and_parses_numbers(spark):
    raw = spark.createDataFrame([("1", " 42 ", "abc", "x")], "vaers_id string, age_yrs string, numdays string, other string")
    row = reports.conform(raw, "raw_vaers_data", "b").first().asDict()
    assert (row["age_yrs"], row["numdays"], row["sex"], row["_load_batch_id"]) == (42.0, None, None, "b")
    assert "other" not in row and row["_ingested_at"] is not None
    child = spark.createDataFrame([("1", "A"), ("1", "B")], "vaers_id string, vax_name string")
    first = {r["_row_id"] for r in reports.conform(child, "raw_vaers_vax", "b").collect()}
    again = {r["_row_id"] for r in reports.conform(child, "raw_vaers_vax", "b").collect()}
    assert len(first) == 2 and first == again


def test_numbers_in_files(spark):
    texts = ["1", " 2.5 ", "-.5", "1e2", "nan", "12d", "", "1,5", "0x10", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in frame.select(reports.number(F.col("t"))).collect()]
    assert got == [1.0, 2.5, -0.5, 100.0, None, None, None, None, None, None]


def test_load_appends_and_counts(spark, tmp_path):
    path = write(tmp_path, "VAX.csv", "vaers_id,vax_name\n1,A\n2,B\n")
    warehouse = str(tmp_path / "raw")
    assert reports.load_files(spark, {"raw_vaers_vax": path}, warehouse, "b1") == {"raw_vaers_vax": 2, "batch_id": "b1"}
    reports.load_files(spark, {"raw_vaers_vax": path}, warehouse, "b2")
    assert tables.read_table(spark, warehouse, "raw_vaers_vax").count() == 4


def test_append_checks_columns_and_prunes_days(spark, tmp_path):
    warehouse = str(tmp_path)
    step = spark.sql("select 'e1' event_id, 'r' run_id, timestamp'2024-01-01 10:00:00' created_at")
    tables.append(step, warehouse, "agt_step_event")
    tables.append(step.withColumn("created_at", F.lit(datetime.datetime(2024, 1, 5))), warehouse, "agt_step_event")
    assert tables.read_table(spark, warehouse, "agt_step_event").count() == 2
    one = tables.read_partition(spark, warehouse, "agt_step_event", "2024-01-04", "2024-01-06")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(_date" in one._jdf.queryExecution().toString()
    review = spark.createDataFrame([("r1", "approve")], "run_id string, action string")
    tables.append(review, warehouse, "agt_human_review_event")
    stored = tables.read_table(spark, warehouse, "agt_human_review_event").first()
    assert stored["review_id"] and stored["reviewed_at"] and stored["rationale"] is None
    with pytest.raises(ValueError, match="no column shoe"):
        tables.append(step.withColumn("shoe", F.lit(1)), warehouse, "agt_step_event")


def test_bucketed_tables_join_without_exchange(spark, tmp_path):
    frame = spark.range(100).selectExpr("cast(id as string) vaers_id", "id")
    for name in ("left_side", "right_side"):
        tables.write_bucketed(frame, name, str(tmp_path / name), "vaers_id", 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = spark.table("left_side").join(spark.table("right_side"), "vaers_id")
    text = joined._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Exchange" not in text and joined.count() == 100
    for name in ("left_side", "right_side"):
        spark.sql(f"drop table {name}")


def test_parameterised_query_and_views(spark):
    report = tables.register_views(
        spark,
        {
            "v_first": lambda s: s.range(5),
            "v_broken": lambda s: s.table("no_such_table"),
            "v_second": lambda s: s.sql("select id * 2 as id from v_first"),
        },
    )
    assert [(n, s == "ok") for n, s in report] == [("v_first", True), ("v_broken", False), ("v_second", True)]
    assert tables.query(spark, "select * from v_second where id > :low", {"low": 3}).count() == 3
    assert tables.query_one(spark, "select :a as a, :b as b", {"a": 1.5, "b": "x"}) == {"a": 1.5, "b": "x"}
    assert tables.query_one(spark, "select 1 where false") is None


STEP = "event_id string, run_id string, vaers_id string, seq long, agent_name string, confidence double, output string, created_at timestamp"


def steps(spark, data):
    at = lambda day: datetime.datetime(2024, 1, day)
    return spark.createDataFrame(
        [(e, "r" + v, v, 1, agent, conf, out, at(day)) for e, v, agent, conf, out, day in data], STEP
    )


FIRST = [("e1", "1", "triage", 0.9, "{}", 1), ("e2", "2", "coding", 0.5, "{}", 3), ("x1", "2", "coding", 1.7, "{}", 3)]
LATER = [
    ("e1", "1", "triage", 0.9, "{}", 1), ("e3", "1", "narrative_qc", 0.4, "{}", 4), ("e4", "3", "triage", 0.8, "{}", 2),
    ("x2", "3", "nobody", 0.8, "{}", 2), ("x3", "3", "triage", 0.8, "not json", 2), ("e4", "3", "triage", 0.8, "{}", 2),
]


def test_audit_stream_appends_once(spark, tmp_path):
    source, warehouse, checkpoint = str(tmp_path / "in"), str(tmp_path / "wh"), str(tmp_path / "cp")
    for part in (FIRST, LATER):
        steps(spark, part).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.file_stream(spark, source, steps(spark, FIRST).schema, files_per_batch=1)
        jobs.audit_stream(stream, warehouse, checkpoint, ()).awaitTermination()
    stored = sink.read_stream_table(spark, warehouse, "agt_step_event")
    assert sorted(r["event_id"] for r in stored.collect()) == ["e1", "e2", "e3", "e4"]
    quarantine = spark.read.parquet(f"{warehouse}/{jobs.QUARANTINE}")
    assert sorted(r["event_id"] for r in quarantine.collect()) == ["x1", "x2", "x3"]
    # a retried batch replaces its folder
    sink.write_batch(steps(spark, LATER[1:2]), warehouse, "agt_step_event", 1, "event_id")
    assert sink.read_stream_table(spark, warehouse, "agt_step_event").count() == 3


def test_status_stream_equals_batch(spark, tmp_path, rows):
    source, warehouse, checkpoint = str(tmp_path / "in"), str(tmp_path / "wh"), str(tmp_path / "cp")
    for part in (FIRST, LATER):
        steps(spark, part).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.file_stream(spark, source, steps(spark, FIRST).schema, files_per_batch=1)
        jobs.status_stream(stream, warehouse, checkpoint).awaitTermination()
    streamed = jobs.read_status(spark, warehouse)
    batch = surfaces.case_status(steps(spark, FIRST + LATER))
    assert rows(streamed, *batch.columns) == rows(batch)
    assert rows(surfaces.open_cases(batch), "vaers_id") == [("1",)]


def test_audit_stream_finds_repeats_whatever_their_time(spark, tmp_path):
    warehouse = str(tmp_path / "wh")
    sink.write_batch(steps(spark, FIRST[:2]), warehouse, "agt_step_event", 0, "event_id")
    moved = steps(spark, [("e1", "1", "triage", 0.9, "{}", 9), ("e5", "1", "triage", 0.9, "{}", 9)])
    timeless = steps(spark, FIRST[1:2]).withColumn("created_at", F.lit(None).cast("timestamp"))
    sink.write_batch(moved.unionByName(timeless), warehouse, "agt_step_event", 1, "event_id")
    stored = sink.read_stream_table(spark, warehouse, "agt_step_event")
    assert sorted(r["event_id"] for r in stored.collect()) == ["e1", "e2", "e5"]


def test_scratch_folders_are_removed(spark):
    folder = session.work_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with session.scratch(spark):
        assert session.stage_table(spark.range(3), "x").count() == 3
        assert set(os.listdir(folder)) != before
    assert set(os.listdir(folder)) == before


def test_errors_are_kept_whole(spark):
    message = "first line\n" + "x" * 500

    def failing(_):
        raise ValueError(message)

    inputs = spark.createDataFrame([("r1", "text")], "run_id string, input_text string")
    assert predict.predict(inputs, failing).first()["error"] == message


def test_outputs_must_keep_their_contract(spark):
    good = '{"valid":true,"missing_criteria":[],"seriousness_screen":{"serious":false,"criteria_flagged":[]},"priority":"standard","confidence":0.5}'
    rows = [("a", "1", "triage", 0.9, good, 1), ("b", "1", "triage", 0.9, '{"confidence":7}', 1), ("c", "1", "coding", 0.9, "{}", 1), ("d", "1", "coding", 0.9, None, 1)]
    judged = {r["event_id"]: r["sound"] for r in jobs.step_is_sound(steps(spark, rows)).collect()}
    assert judged == {"a": True, "b": False, "c": False, "d": False}


def test_status_folders_are_compacted(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(jobs, "STATUS_GENERATION", 2)
    source, warehouse, checkpoint = str(tmp_path / "in"), str(tmp_path / "wh"), str(tmp_path / "cp")
    data = [(f"e{n}", str(n % 3 if n < 6 else 7), "triage", 0.9, "{}", n + 1) for n in range(8)]
    for step in data:
        steps(spark, [step]).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.file_stream(spark, source, steps(spark, data).schema, files_per_batch=1)
        jobs.status_stream(stream, warehouse, checkpoint).awaitTermination()
    kept = sink.batch_folders(spark, f"{warehouse}/{jobs.STATUS}")
    assert sorted(kept) == [4, 5, 6, 7]
    batch = surfaces.case_status(steps(spark, data))
    assert rows(jobs.read_status(spark, warehouse), *batch.columns) == rows(batch)


def test_intake_records_failures_and_tries_them_again(spark, tmp_path):
    dictionary = spark.createDataFrame([("Rash", "1")], "pt_term string, meddra_version string")
    products = spark.createDataFrame([("X",)], "vax_name string")
    ref = case_run.Reference(dictionary, products, spark.createDataFrame([("X", True)], "vax_name string, in_scope boolean"))
    cases = spark.createDataFrame([("1",), ("2",)], "vaers_id string")
    told = [("1", "Rash after X", "01012024"), ("2", "unreadable", "01012024")]
    source, warehouse, checkpoint = str(tmp_path / "in"), str(tmp_path / "wh"), str(tmp_path / "cp")

    def reader(fails):
        def triage(texts):
            if fails and any("unreadable" in t for t in texts):
                raise ValueError("no text")
            screen = {"serious": False, "criteria_flagged": []}
            return [json.dumps({"valid": True, "missing_criteria": [], "seriousness_screen": screen, "priority": "standard", "confidence": 0.9}) for _ in texts]

        return triage

    for fails in (True, False, False):
        reports_now = spark.createDataFrame(told, "vaers_id string, narrative string, received_date string")
        reports_now.coalesce(1).write.mode("append").parquet(source)
        stream = jobs.file_stream(spark, source, reports_now.schema)
        jobs.intake_stream(stream, ref, cases, warehouse, checkpoint, min_chars=1, predictors={"triage": reader(fails)}, models={"triage": "m"}).awaitTermination()
    stored = sink.read_stream_table(spark, warehouse, "agt_run").collect()
    assert sorted((r["vaers_id"], r["status"]) for r in stored) == [("1", "completed"), ("2", "completed"), ("2", "failed")]
