"""Normalisation and agreement helpers on known values."""

import random

from pyspark.sql import functions as F

from safetylake.functions import measures, text
from safetylake.operators import concordance, evaluation


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_normalisers(spark):
    assert value(spark, text.normalize_pt(F.lit("\t Chest   pain\n"))) == "CHEST PAIN"
    assert value(spark, text.normalize_pt(F.lit(None).cast("string"))) == ""
    assert value(spark, text.term_key(F.lit("\n a  b\t"))) == "A  B"
    assert value(spark, text.normalize_product(F.lit("COVID19 (PFIZER-BIONTECH)"))) == "COVID19 PFIZER BIONTECH"
    assert [value(spark, text.normalize_sex(F.lit(s))) for s in (" M", "male", "F ", "Female", "x", None)] == [
        "male", "male", "female", "female", "unknown", "unknown",
    ]
    assert not value(spark, text.is_filled(F.lit(" \t")))
    assert value(spark, text.is_filled(F.lit(None).cast("string"))) is False


def test_age_match(spark):
    def match(a, b):
        return value(spark, measures.age_match(F.lit(a).cast("double"), F.lit(b).cast("double")))

    assert match(42, 42.4) is True
    assert match(42, 50) is False
    assert match(None, 50) is None


def test_coding_concordance_is_set_based(spark):
    predicted = spark.createDataFrame(
        [("1", "Headache"), ("1", "headache"), ("1", "Pyrexia"), ("1", None), ("1", ""), ("2", "X"), ("3", None)],
        "vaers_id string, term string",
    )
    gold = spark.createDataFrame([("1", "headache"), ("1", "Chills")], "vaers_id string, term string")
    got = {r["vaers_id"]: r for r in concordance.coding_concordance(predicted, gold).collect()}
    assert (got["1"]["tp"], got["1"]["fp"], got["1"]["fn"], got["1"]["f1"]) == (1, 1, 1, 0.5)
    assert got["2"]["recall"] is None and got["2"]["precision"] == 0.0
    assert got["3"]["f1"] is None


def normal(name):
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in name.lower()).split()).upper()


def test_product_concordance_equals_brute_force(spark):
    rng = random.Random(7)
    names = ["COVID19 (PFIZER-BIONTECH)", "covid19 pfizer-biontech", "FLU", "FLU3 (X)", "flu3", "---", "", None, "MMR II", "II"]
    wanted = [(str(rng.randrange(40)), rng.choice(names)) for _ in range(120)]
    found = [(str(rng.randrange(40)), rng.choice(names)) for _ in range(80)]
    schema = "vaers_id string, product string"
    got = concordance.product_concordance(spark.createDataFrame(found, schema), spark.createDataFrame(wanted, schema))
    got = {r["vaers_id"]: r["recall"] for r in got.collect()}
    for key in {k for k, _ in wanted}:
        truth = [normal(p) for k, p in wanted if k == key and p]
        have = [normal(p) for k, p in found if k == key and p]
        hits = sum(any(g in e or e in g for e in have) for g in truth)
        assert got[key] == (hits / len(truth) if truth else None), key


def test_guarded_correlation(spark):
    def corr(pairs):
        df = spark.createDataFrame(pairs, "x double, y double")
        return df.agg(measures.guarded_corr(F.col("x"), F.col("y")).alias("c")).first()["c"]

    assert corr([(1.0, 2.0)]) is None
    assert corr([(1.0, 2.0), (1.0, 3.0)]) is None
    assert abs(corr([(1.0, 2.0), (2.0, 4.0), (3.0, None)]) - 1.0) < 1e-12


def test_eval_counts_repeats_and_ignores_null_terms(spark):
    outputs = spark.createDataFrame(
        [
            ("r1", "1", "v", [" Pyrexia", "PYREXIA", "Chills", None], '{"serious": true}'),
            ("r2", "1", "v", None, '{"serious": "x"}'),
            ("r3", "9", "v", ["Pyrexia"], None),
        ],
        "run_id string, vaers_id string, pipeline_version string, coded_pts array<string>, seriousness string",
    )
    long = spark.createDataFrame(
        [("1", "Pyrexia ", 24.0), ("1", "pyrexia", 25.0), ("1", "Headache", 24.0)],
        "vaers_id string, pt_term string, meddra_version double",
    )
    facts = spark.createDataFrame([("1", True), ("9", False)], "vaers_id string, serious boolean")
    got = {r["run_id"]: r for r in evaluation.eval_case(outputs, long, facts).collect()}
    assert set(got) == {"r1", "r2"}
    assert (got["r1"]["tp"], got["r1"]["fp"], got["r1"]["fn"]) == (2, 1, 1)
    assert got["r1"]["seriousness_match"] is True
    assert (got["r2"]["tp"], got["r2"]["fp"], got["r2"]["fn"]) == (0, 0, 2)
    assert got["r2"]["precision"] is None and got["r2"]["seriousness_match"] is None
    for r in got.values():
        assert r["tp"] + r["fp"] in (3, 0)
