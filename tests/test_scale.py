"""Plans and results when one case, product or term holds a large share of the rows."""

import re

import pytest
from pyspark.sql import functions as F

from safetylake.operators import concordance, evaluation, reference, signals, surfaces, truth
from safetylake.plans import case_run
from safetylake.plans.catalog import Inputs

SF_DIR = "/root/testdata/sf0.001"
HOT = 4000


@pytest.fixture()
def shuffled_joins(spark):
    """Joins as at scale: no broadcast, small thresholds for skew."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_pairwise_joins(spark, shuffled_joins):
    i = Inputs(spark, SF_DIR)
    frames = [
        i.metrics, i.truth, i.evaluated, i.compared, i.dictionary, i.read,
        surfaces.review_queue(i.outputs, i.view("reviews")),
    ]
    for frame in frames:
        assert not re.search("CartesianProduct|NestedLoopJoin", plan(frame))


def test_scan_reads_only_needed_columns_and_pushes_filters(spark, tmp_path):
    path = str(tmp_path / "vax")
    Inputs(spark, SF_DIR).vax.write.parquet(path)
    text = plan(reference.product_scope(spark.read.parquet(path), "PROMO"))
    assert "EqualTo(vax_type,PROMO)" in text
    assert re.search(r"ReadSchema: struct<vax_type:string,vax_manu:string,vax_name:string>", text)


def test_latest_run_is_limited_before_the_shuffle(spark):
    text = plan(surfaces.latest_run(Inputs(spark, SF_DIR).outputs))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_hot_product_is_split_in_the_join(spark, shuffled_joins):
    vax = spark.range(30 * HOT).select(
        F.col("id").cast("string").alias("vaers_id"),
        F.when(F.col("id") % 3 < 2, "HOT").otherwise(F.concat(F.lit("P"), F.col("id") % 500)).alias("vax_name"),
    ).repartition(8)
    scope = spark.createDataFrame([("HOT", True), ("P4", True)], "vax_name string, in_scope boolean")
    found = reference.in_scope_cases(vax, scope)
    text = executed(found)
    assert "skew=true" in text
    assert found.count() == vax.filter("vax_name in ('HOT', 'P4')").count()


def hot_outputs(spark):
    """One case holds most runs; its runs and the reports behind it are loaded many times."""
    return spark.range(HOT).select(
        F.concat(F.lit("r"), "id").alias("run_id"),
        F.when(F.col("id") % 4 < 3, "hot").otherwise(F.col("id").cast("string")).alias("vaers_id"),
        F.lit("v").alias("pipeline_version"),
        F.array(F.lit("Rash"), F.lit("Chills")).alias("coded_pts"),
        F.lit('{"serious": true}').alias("seriousness"),
    )


def hot_reports(spark):
    return spark.range(HOT).select(
        F.when(F.col("id") % 4 < 3, "hot").otherwise(F.col("id").cast("string")).alias("vaers_id"),
        F.lit("Rash").alias("pt_term"), F.lit(24.0).alias("meddra_version"), F.lit(True).alias("serious"),
        F.lit("M").alias("sex"), F.lit(40.0).alias("age_yrs"),
    )


def test_hot_case_stays_linear(spark, shuffled_joins):
    scored = evaluation.eval_case(hot_outputs(spark), hot_reports(spark), hot_reports(spark))
    assert scored.count() == HOT
    totals = scored.agg(F.sum("tp"), F.sum("fp"), F.sum("fn")).first()
    assert tuple(totals) == (HOT, HOT, 0)
    people = hot_reports(spark).withColumnRenamed("age_yrs", "age_years")
    both = concordance.demographic_concordance(people, hot_reports(spark))
    assert both.count() == HOT and both.filter("not (sex_match and age_match)").count() == 0
    events = signals.case_event(hot_outputs(spark))
    assert events.count() == 2 * (1 + HOT // 4)
    assert truth.gt_pt(hot_reports(spark)).count() == 1 + HOT // 4


def test_hot_product_names_in_one_case(spark, shuffled_joins):
    listed = spark.range(HOT).select(F.lit("hot").alias("vaers_id"), F.concat(F.lit("Vax "), F.col("id") % 700).alias("product"))
    row = concordance.product_concordance(listed.filter("product <> 'Vax 5'"), listed).first()
    assert (row["n_products"], row["n_found"]) == (HOT, HOT)  # "Vax 5" is inside "Vax 50"


def test_hot_term_and_huge_vocabulary_are_read_without_broadcast(spark, shuffled_joins):
    dictionary = spark.createDataFrame([("Rash", "1"), ("Rare thing", "1")], "pt_term string, meddra_version string")
    products = spark.createDataFrame([("X",)], "vax_name string")
    scope = spark.createDataFrame([("X", True)], "vax_name string, in_scope boolean")
    reports = spark.range(HOT).select(
        F.col("id").cast("string").alias("vaers_id"),
        F.when(F.col("id") == 7, "Rash, then a rare thing.").otherwise("Rash rash rash the rash.").alias("narrative"),
        F.lit(None).cast("string").alias("received_date"),
    )
    runs = case_run.run_cases(reports, case_run.Reference(dictionary, products, scope), ("extraction", "coding"))
    got = runs.select(F.explode("coding.result.coded.meddra_pt").alias("pt")).groupBy("pt").count().collect()
    assert {r["pt"]: r["count"] for r in got} == {"Rash": HOT, "Rare thing": 1}
