"""Report-shaped views over the star-schema test tables (see FIXTURES.md).

Every view is plain DataFrame work over whole tables. The lists inside a view are built
after a pre-aggregation, so their length is bounded by the part-name vocabulary and not
by the number of line items of an order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from safetylake.functions.lookup import lookup

SCOPE_TYPE = "PROMO"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _key(c: str) -> Column:
    return F.col(c).cast("string")


def _onset(key: str) -> Column:
    return F.date_add(F.to_date("o_orderdate"), (F.col(key) % 30).cast("int"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    lineitem = table(spark, sf_dir, "lineitem")
    return lineitem.join(part, lineitem.l_partkey == part.p_partkey)


def _product(p_type: str = "p_type", p_brand: str = "p_brand") -> Column:
    return F.concat(F.col(p_type), F.lit(" ("), F.col(p_brand), F.lit(")"))


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_vaers_data, used columns."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    k, q = F.col("o_orderkey"), F.col("o_custkey")
    no_or_blank = F.when(k % 3 == 0, "N")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    report_date = F.date_format("o_orderdate", "MMddyyyy")
    return (
        orders.join(customer, q == F.col("c_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(documents, k == F.col("doc_id"), "left")
        .select(
            _key("o_orderkey").alias("vaers_id"),
            report_date.alias("recvdate"),
            F.col("n_name").alias("state"),
            F.when(q % 11 != 0, (q % 100).cast("double")).alias("age_yrs"),
            F.when(q % 5 < 2, "M").when(q % 5 < 4, "F").alias("sex"),
            F.col("text").alias("symptom_text"),
            F.when(urgent & (F.col("o_orderstatus") == "F"), "Y").otherwise(no_or_blank).alias("died"),
            F.when(k % 17 == 0, "Y").otherwise(no_or_blank).alias("l_threat"),
            F.when(urgent, "Y")
            .when(F.col("o_orderpriority") == "2-HIGH", "N")
            .otherwise(no_or_blank)
            .alias("hospital"),
            F.when(k % 29 == 0, "Y").otherwise("N").alias("disable"),
            F.when(k % 4 == 0, "Y").when(k % 4 == 1, "N").alias("recovd"),
            report_date.alias("vax_date"),
            F.when(k % 13 == 0, "02302024")
            .otherwise(F.date_format(_onset("o_orderkey"), "MMddyyyy"))
            .alias("onset_date"),
            (k % 30).cast("double").alias("numdays"),
            F.when(k % 101 == 0, "Y").otherwise(no_or_blank).alias("birth_defect"),
        )
    )


def vax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_vaers_vax."""
    return _lines(spark, sf_dir).select(
        _key("l_orderkey").alias("vaers_id"),
        F.col("p_type").alias("vax_type"),
        F.col("p_brand").alias("vax_manu"),
        _key("l_suppkey").alias("vax_lot"),
        _key("l_linenumber").alias("vax_dose_series"),
        _product().alias("vax_name"),
    )


def symptoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_vaers_symptoms: five (term, version) slots per row."""
    slots = []
    for slot in range(1, 6):
        here = F.col("l_linenumber") % 5 == slot - 1
        slots.append(F.max(F.when(here, F.col("p_name"))).alias(f"symptom{slot}"))
        slots.append(
            F.max(F.when(here, (24 + F.col("l_suppkey") % 3).cast("double"))).alias(
                f"symptomversion{slot}"
            )
        )
    return (
        _lines(spark, sf_dir)
        .groupBy("l_orderkey", (F.col("l_suppkey") % 2).alias("half"))
        .agg(*slots)
        .select(_key("l_orderkey").alias("vaers_id"), *[
            f"{stem}{slot}" for slot in range(1, 6) for stem in ("symptom", "symptomversion")
        ])
    )


def outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """agt_case_output: two runs per case, repeated, blank and NULL terms, empty lists."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    promo = F.col("p_type") == SCOPE_TYPE
    strong_tax = F.col("l_tax") >= 0.07
    pt = (
        F.when(promo & (F.col("l_orderkey") % 97 == 0), F.lit("rare promo event"))
        .when(strong_tax & (promo | (F.col("l_orderkey") % 50 == 0)), F.lit("promo reaction"))
        .when(strong_tax, F.concat(F.lower("p_type"), F.lit(" reaction")))
        .when((F.col("l_linenumber") == 7) & (F.col("l_discount") == 0), F.lit(" "))
        .otherwise(F.concat(F.lit(" "), F.col("p_name")))
    )
    # A term used by several line items of a run is listed twice: count first, so that the
    # list never grows beyond twice the vocabulary. Both runs of a case are made of one row of its order.
    runs = (1, 2)
    counted = (
        _lines(spark, sf_dir)
        .select("l_orderkey", pt.alias("pt"), (F.col("l_returnflag") != "R").alias("in1"), (F.col("l_returnflag") != "A").alias("in2"))
        .groupBy("l_orderkey", "pt")
        .agg(*[F.count_if(f"in{v}").alias(f"n{v}") for v in runs])
    )

    def listed(n: str) -> Column:
        return F.when(F.col(n) > 1, F.array("pt", "pt")).when(F.col(n) == 1, F.array("pt"))

    lists = counted.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        *[F.sort_array(F.flatten(F.collect_list(listed(f"n{v}")))).alias(f"pts{v}") for v in runs]
    )
    k = F.col("o_orderkey")
    serious = (k % 10 == 0) | (F.col("o_orderpriority") == "1-URGENT")
    category = F.element_at(
        F.split(F.lit("certain,probable,possible,unlikely,conditional,unassessable"), ","),
        (k % 6 + 1).cast("int"),
    )
    return (
        orders.join(lists, "o_orderkey", "left")
        .select("*", F.explode(F.array(*[F.struct(F.lit(v).alias("v"), F.col(f"pts{v}").alias("coded_pts")) for v in runs])).alias("of"))
        .select("*", "of.*")
        .select(
            F.concat(k.cast("string"), F.lit("-r"), F.col("v").cast("string")).alias("run_id"),
            _key("o_orderkey").alias("vaers_id"),
            F.concat(F.lit("pipeline@0."), F.col("v").cast("string")).alias("pipeline_version"),
            F.coalesce("coded_pts", F.array().cast("array<string>")).alias("coded_pts"),
            F.concat(
                F.lit('{"serious":'), serious.cast("string"), F.lit(',"criteria_met":[]}')
            ).alias("seriousness"),
            F.concat(F.lit('{"method":"WHO-UMC","category":"'), category, F.lit('"}')).alias("causality"),
            F.concat(F.lit("Run "), F.col("v").cast("string"), F.lit(" of case "), k.cast("string")).alias(
                "narrative"
            ),
            ((50 + k % 50).cast("double") / 100).alias("overall_confidence"),
            (k % 50 < 25).alias("hitl_required"),
            (F.col("o_orderdate") + F.make_dt_interval(F.col("v"))).alias("created_at"),
        )
    )


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """run_id, vaers_id and the extracted case as JSON text."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    n_events = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.countDistinct("l_linenumber").alias("n"))
    )
    k, q = F.col("o_orderkey"), F.col("o_custkey")
    sex = (
        F.when(k % 8 == 0, "unknown").when(q % 5 < 2, "male").when(q % 5 < 4, "female").otherwise("unknown")
    )
    age = F.when(k % 9 == 0, F.lit("null")).otherwise((q % 100 + k % 3).cast("string"))
    onset = F.when(k % 13 == 0, F.lit("null")).otherwise(
        F.concat(F.lit('"'), F.date_format(_onset("o_orderkey"), "yyyy-MM-dd"), F.lit('"'))
    )
    events = F.when(
        F.col("n") > 0,
        F.array_join(
            F.transform(
                F.sequence(F.lit(1), F.col("n").cast("int")),
                lambda i: F.concat(F.lit('{"verbatim":"e'), i.cast("string"), F.lit('"}')),
            ),
            ",",
        ),
    ).otherwise(F.lit(""))
    return orders.join(n_events, "o_orderkey", "left").select(
        F.concat(k.cast("string"), F.lit("-r1")).alias("run_id"),
        k.cast("string").alias("vaers_id"),
        F.concat(
            F.lit('{"patient":{"age_years":'), age, F.lit(',"sex":"'), sex,
            F.lit('"},"onset_date":'), onset, F.lit(',"events":['), events, F.lit("]}"),
        ).alias("extracted"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """agt_human_review_event, used columns."""
    k = F.col("o_orderkey")
    action = (
        F.when((k % 7 == 0) & (k % 2 == 0), "approve")
        .when(k % 7 == 0, "reject")
        .when(k % 2 == 0, "edit")
        .otherwise("escalate")
    )
    return (
        table(spark, sf_dir, "orders")
        .select(
            F.concat(F.lit("rev-"), k.cast("string")).alias("review_id"),
            F.concat(k.cast("string"), F.lit("-r2")).alias("run_id"),
            k.cast("string").alias("vaers_id"),
            F.concat(F.lit("reviewer-"), (k % 5).cast("string")).alias("reviewer_id"),
            action.alias("action"),
            (F.col("o_orderdate") + F.make_dt_interval(F.lit(5))).alias("reviewed_at"),
        )
    )


# agent per event type, in stage order
STEP_OF_EVENT = [
    ("signup", "triage"),
    ("view", "extraction"),
    ("click", "coding"),
    ("purchase", "assessment"),
    ("error", "narrative_qc"),
]


def steps_of(events: DataFrame) -> DataFrame:
    """agt_step_event over an events frame, batch or streaming."""
    kind = F.col("event_type")
    agent = lookup(kind, dict(STEP_OF_EVENT))
    seq = lookup(kind, {event: n for n, (event, _) in enumerate(STEP_OF_EVENT, 1)}).cast("bigint")
    return events.select(
        F.concat(F.lit("evt-"), _key("event_id")).alias("event_id"),
        F.concat(F.lit("run-"), _key("user_id")).alias("run_id"),
        _key("user_id").alias("vaers_id"),
        seq.alias("seq"),
        agent.alias("agent_name"),
        ((F.col("event_id") % 101).cast("double") / 100).alias("confidence"),
        F.col("props").alias("output"),
        F.col("ts").alias("created_at"),
    )


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steps_of(table(spark, sf_dir, "events"))


def narratives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vaers_id, narrative, received date: one written report per order."""
    orders = table(spark, sf_dir, "orders")
    facts = (
        _lines(spark, sf_dir)
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.min(_product()).alias("product"),
            F.max(_product()).alias("last"),
            F.array_join(F.sort_array(F.collect_set("p_name")), "; ").alias("events"),
        )
    )
    k, q = F.col("o_orderkey"), F.col("o_custkey")
    text = lambda c: c.cast("string")
    say = lambda cond, words: F.when(cond, F.lit(words)).otherwise(F.lit(""))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    who = F.when(q % 5 < 2, "male").when(q % 5 < 4, "female").otherwise("adult")
    age = F.when(q % 11 == 0, F.lit("")).otherwise(F.concat(text(q % 100), F.lit("-year-old ")))
    parts = [
        F.lit("A "), age, who, F.lit(" received "),
        F.coalesce("product", F.lit("an unknown product")),
        F.lit(" on "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(". "),
        F.when(k % 13 == 0, F.lit("")).when(
            k % 53 == 0,
            F.concat(F.lit("Onset "), F.date_format(F.date_sub(F.to_date("o_orderdate"), 3), "yyyy-MM-dd"), F.lit(". ")),
        ).otherwise(F.concat(F.lit("Onset "), F.date_format(_onset("o_orderkey"), "yyyy-MM-dd"), F.lit(". "))),
        F.when(k % 19 == 0, F.concat(F.lit("Symptoms began "), text(k % 30 + F.when(k % 38 == 0, 1).otherwise(0)), F.lit(" days after the dose. "))).otherwise(F.lit("")),
        F.lit("Events: "), F.coalesce("events", F.lit("none stated")), F.lit("."),
        F.when(k % 5 == 0, F.lit(" Reported by a nurse.")).when(k % 5 == 1, F.lit(" Reported by a Physician.")).when(k % 5 == 2, F.lit(" The patient called.")).otherwise(F.lit("")),
        say(urgent & (F.col("o_orderstatus") == "F"), " The outcome was fatal."),
        say(urgent, " Was hospitalized."),
        say(k % 17 == 0, " Life-threatening reaction."),
        say(k % 29 == 0, " Left disabled."),
        say(k % 101 == 0, " Congenital anomaly noted."),
        say(k % 23 == 0, " Was not admitted, no birth defect."),
        say(k % 21 == 0, " Denied hot anvil but felt hot gear."),
        say(k % 25 == 0, " Has not recovered from hot plate."),
        F.when(
            k % 9 == 0,
            F.concat(
                F.lit(" Then got "), F.coalesce("last", F.lit("the same")), F.lit(" as second dose intramuscularly on "),
                F.date_format(F.date_add(F.to_date("o_orderdate"), 40), "yyyy-MM-dd"), F.lit(" and felt hot gear from "),
                F.date_format(F.date_add(F.to_date("o_orderdate"), 41), "M/d/yyyy"),
                F.lit(", hot bolt resolved while hot plate is ongoing."),
            ),
        ).otherwise(F.lit("")),
        say(k % 6 == 0, " History: asthma; diabetes."),
        say(k % 8 == 0, " Allergies: penicillin."),
        say(k % 10 == 0, " Concomitant medications: aspirin; metformin."),
    ]
    # The order side is partitioned like the aggregated lines, as the join needs at scale.
    return orders.repartition("o_orderkey").join(facts, "o_orderkey", "left").select(
        text(k).alias("vaers_id"),
        F.concat(*parts).alias("narrative"),
        F.date_format("o_orderdate", "MMddyyyy").alias("received_date"),
    )


def term_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Term vectors: every embedding."""
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("term-"), _key("vec_id")).alias("pt_term"), F.col("embedding").alias("vector")
    )


def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verbatim vectors: every embedding, so each verbatim's best term is its own."""
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("verbatim-"), _key("vec_id")).alias("verbatim"), F.col("embedding").alias("vector")
    )
