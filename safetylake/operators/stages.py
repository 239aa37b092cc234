"""Rule-based case stages: each adds one contract-shaped struct column.

A stage sees what a report reader would see: the facts and mentions read from the
narrative, the outputs of earlier stages and the global dictionaries. The case's own
coded terms, flags and product rows stay unseen, because scoring compares against them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from safetylake import schemas as S
from safetylake.functions import text
from safetylake.operators.gathering import listed
from safetylake.operators.grounding import nearest_to
from safetylake.operators.mentions import linked_value
from safetylake.session import stage_table

# --- Fixed values: rule parameters ---------------------------------------------------
MINOR_TERMS = [
    "injection site pain", "injection site erythema", "injection site swelling", "chills",
    "fatigue", "headache", "myalgia", "pyrexia",
]
CODED_SCORE = 0.9
REVIEW_SCORE = 0.6
MANY_GAPS = 3
TIMED_CONFIDENCE = 0.9
UNTIMED_CONFIDENCE = 0.7


def _strings(values: Column) -> Column:
    return values.cast("array<string>")


def _texts(*parts: tuple[Column, str]) -> Column:
    """The names whose condition holds, in the given order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in parts]))


def triage(reports: DataFrame, minor_terms: list[str] = MINOR_TERMS) -> DataFrame:
    """Validity criteria, seriousness screen and priority of a read report."""
    stated = F.col("stated")
    patient = stated["age_years"].isNotNull() | stated["sex"].isNotNull()
    missing = _texts(
        (~patient, "identifiable_patient"),
        (~stated["has_reporter"], "identifiable_reporter"),
        (F.size("products") == 0, "suspect_product"),
        (F.size("events") == 0, "adverse_event"),
    )
    minor = [t.upper() for t in minor_terms]
    only_minor = (F.size("events") > 0) & F.forall(
        "events", lambda e: text.normalize_pt(e["name"]).isin(minor)
    )
    valid = F.size(missing) == 0
    serious = F.size(stated["criteria"]) > 0
    output = F.struct(
        valid.alias("valid"),
        missing.alias("missing_criteria"),
        F.struct(serious.alias("serious"), stated["criteria"].alias("criteria_flagged")).alias(
            "seriousness_screen"
        ),
        F.when(serious, "expedited")
        .when(valid & only_minor, "non_serious")
        .otherwise("standard")
        .alias("priority"),
        F.round(1.0 - 0.2 * F.size(missing), 4).alias("confidence"),
        F.when(~valid, F.concat(F.lit("missing: "), F.array_join(missing, ", "))).alias("rationale"),
    )
    return reports.withColumn("triage", output.cast(S.TRIAGE_OUTPUT))


def _iso(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def extraction(reports: DataFrame) -> DataFrame:
    """Structured case from stated facts and mentions; what is not stated stays NULL.

    A product takes the maker, dose number and route, an event the onset date and outcome that are
    tied to it inside a clause.
    """
    stated = F.col("stated")
    gap = F.datediff(stated["onset_date"], stated["vaccination_date"]).cast("bigint")
    products = F.transform(
        "products",
        lambda p: F.struct(
            p["name"].alias("name"),
            linked_value("maker", "product", p["name"]).alias("manufacturer"),
            linked_value("dose", "product", p["name"]).alias("dose_series"),
            linked_value("route", "product", p["name"]).alias("route"),
            F.when(p["in_scope"], "suspect").otherwise("concomitant").alias("role"),
        ),
    )
    events = F.transform(
        "events",
        lambda e: F.struct(
            e["verbatim"].alias("verbatim"),
            linked_value("date", "event", e["name"]).alias("onset_date"),
            linked_value("outcome", "event", e["name"]).alias("outcome"),
        ),
    )
    found = [
        stated["age_years"].isNotNull(), stated["sex"].isNotNull(), F.size("products") > 0,
        F.size("events") > 0, stated["onset_date"].isNotNull(),
    ]
    share = reduce(lambda a, b: a + b, [f.cast("int") for f in found]).cast("double") / len(found)
    case = F.struct(
        F.struct(
            stated["age_years"].alias("age_years"),
            F.coalesce(stated["sex"], F.lit("unknown")).alias("sex"),
        ).alias("patient"),
        products.alias("products"),
        events.alias("events"),
        _iso(stated["vaccination_date"]).alias("vaccination_date"),
        _iso(stated["onset_date"]).alias("onset_date"),
        F.coalesce(stated["stated_days"], gap).alias("days_to_onset"),
        stated["concomitant_meds"].alias("concomitant_meds"),
        stated["medical_history"].alias("medical_history"),
        stated["allergies"].alias("allergies"),
    )
    output = F.struct(case.alias("case"), F.round(share, 4).alias("confidence"))
    return reports.withColumn("extraction", output.cast(S.EXTRACTION_OUTPUT))


def code_terms(verbatims: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Dictionary term of each distinct verbatim: equal normalised text, else nearest vector.

    Returns verbatim, meddra_pt (NULL when nothing is close), meddra_version, confidence and
    requires_review. Vectors are built only for verbatims without an equal term.
    """
    terms = (
        dictionary.withColumn("normal", text.normalize_pt(F.col("pt_term")))
        .groupBy("normal")
        .agg(F.min(F.struct("pt_term", "meddra_version")).alias("term"))
    )
    # Distinct verbatims are few beside the events: write them once, they are read again below.
    looked_up = stage_table(
        verbatims.select("verbatim")
        .distinct()
        .withColumn("normal", text.normalize_pt(F.col("verbatim")))
        .join(terms, "normal", "left")
        .select("verbatim", "normal", "term.pt_term", "term.meddra_version"),
        "verbatims",
    )
    scored = looked_up.filter("pt_term is not null").select(
        "verbatim", "pt_term", "meddra_version", F.lit(1.0).alias("score")
    )
    other = looked_up.filter("pt_term is null").select("verbatim", "normal")
    words = other.filter("normal <> ''")
    nearest = nearest_to(words, dictionary, k=1).select("verbatim", "pt_term", "score")
    versions = dictionary.groupBy("pt_term").agg(F.min("meddra_version").alias("meddra_version"))
    scored = scored.unionAll(
        other.join(nearest, "verbatim", "left")
        .join(versions, "pt_term", "left")
        .select("verbatim", "pt_term", "meddra_version", F.coalesce("score", F.lit(0.0)))
    )
    close = F.col("score") >= REVIEW_SCORE
    return scored.select(
        "verbatim",
        F.when(close, F.col("pt_term")).alias("meddra_pt"),
        F.when(close, F.col("meddra_version")).alias("meddra_version"),
        F.round("score", 4).alias("confidence"),
        (close & (F.col("score") < CODED_SCORE)).alias("requires_review"),
    )


def _with_entries(
    cases: DataFrame, found: DataFrame, width: Column, keep: list[str], entry: Column
) -> DataFrame:
    """(kept, entries) per case: ``entry`` of each of its verbatims in event order, with the row of ``found`` it meets.

    ``cases`` holds each run_id once, ``found`` each verbatim once, some ``width`` bytes a row. Only the first event row
    of a case carries its other columns. A ``found`` below the session's broadcast limit is broadcast: the events of a
    case then still follow one another and are put together as they pass, without a shuffle, a sort or an aggregation.
    A larger one is shuffled with the events, which are then dealt and sorted by run_id.
    """
    events = cases.select(
        F.struct("run_id", *keep).alias("case_row"),
        F.posexplode_outer("extraction.case.events.verbatim").alias("pos", "verbatim"),
    )
    leads = F.col("pos").isNull() | (F.col("pos") == 0)
    events = events.select(
        F.when(leads, F.col("case_row")).alias("kept"), leads.alias("leads"), "pos", "verbatim",
        F.col("case_row.run_id").alias("run_id"),
    )
    size = found.agg(F.sum(width + 64).alias("bytes")).first()["bytes"] or 0
    conf = cases.sparkSession._jsparkSession.sessionState().conf()
    narrow = size <= conf.autoBroadcastJoinThreshold()
    looked_up = events.join(F.broadcast(found) if narrow else found, "verbatim", "left")
    if not narrow:
        looked_up = looked_up.repartition("run_id").sortWithinPartitions("run_id", "pos")
    rows = looked_up.select("kept", "leads", F.when(F.col("verbatim").isNotNull(), entry).alias("entry"))
    of = {field.name: field.dataType for field in rows.schema}
    shape = T.StructType().add("kept", of["kept"]).add("entries", T.ArrayType(of["entry"]))
    return rows.mapInArrow(listed, shape)


def _length(*columns: str) -> Column:
    return reduce(Column.__add__, [F.coalesce(F.length(c), F.lit(0)) for c in columns])


def coding(cases: DataFrame, coded_terms: DataFrame, keep: list[str]) -> DataFrame:
    """Term per event of each case, in event order; cases without events get an empty result.

    ``cases`` holds each run_id once, ``coded_terms`` each verbatim once. The events of a case are not shuffled unless
    there are more terms than a broadcast holds, see ``_with_entries``.
    """
    entry = F.struct("verbatim", "meddra_pt", "meddra_version", "confidence", "requires_review")
    width = _length("verbatim", "meddra_pt", "meddra_version")
    grouped = _with_entries(cases, coded_terms, width, keep, entry)
    hits = F.filter("entries", lambda e: e["meddra_pt"].isNotNull())
    misses = F.filter("entries", lambda e: e["meddra_pt"].isNull())
    coded = F.transform(
        hits,
        lambda e: F.struct(
            e["verbatim"].alias("verbatim"), e["meddra_pt"].alias("meddra_pt"),
            e["meddra_version"].alias("meddra_version"), e["confidence"].alias("confidence"),
            e["requires_review"].alias("requires_review"),
        ),
    )
    confidence = (
        F.when(F.size("entries") == 0, F.lit(1.0))
        .when(F.size(hits) == 0, F.lit(0.0))
        .otherwise(F.array_min(F.transform(hits, lambda e: e["confidence"])))
    )
    output = F.struct(
        F.struct(
            coded.alias("coded"), F.transform(misses, lambda e: e["verbatim"]).alias("uncoded")
        ).alias("result"),
        confidence.alias("confidence"),
    )
    return grouped.withColumn("coding", output.cast(S.CODING_OUTPUT)).select("kept.*", "coding")


# --- Fixed values: rendered texts ----------------------------------------------------
NO_CANDIDATES = "(no candidates retrieved)"
CODE_HEADER = "Code each event below.\n\n"


def _or_none(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def render_candidates(cases: DataFrame, candidates: DataFrame) -> DataFrame:
    """Numbered events of each case with their candidate terms, as one text per run.

    ``cases`` holds run_id and verbatims in order, ``candidates`` verbatim and its list.
    """
    events = cases.select("run_id", F.posexplode("verbatims").alias("pos", "verbatim"))
    shown = F.when(F.size("candidates") > 0, F.array_join("candidates", "; ")).otherwise(
        F.lit(NO_CANDIDATES)
    )
    line = F.concat(
        (F.col("pos") + 1).cast("string"), F.lit(". Event: "), F.col("verbatim"),
        F.lit("\n   Candidate PTs: "), shown,
    )
    lines = (
        events.join(candidates, "verbatim", "left")
        .groupBy("run_id")
        .agg(F.array_sort(F.collect_set(F.struct("pos", line.alias("line")))).alias("lines"))
    )
    joined = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    return lines.select("run_id", F.concat(F.lit(CODE_HEADER), joined).alias("prompt"))


def with_candidates(cases: DataFrame, candidates: DataFrame, keep: list[str]) -> DataFrame:
    """The cases with ``input_text``: the text of ``render_candidates``, the header alone where there are no events.

    As in ``coding`` the events of a case are not shuffled unless there are more candidates than a broadcast holds.
    """
    none = F.array().cast("array<string>")
    lists = candidates.groupBy("verbatim").agg(F.collect_set(F.coalesce("candidates", none)).alias("lists"))
    width = _length("verbatim") + F.length(F.to_json("lists"))
    grouped = _with_entries(cases, lists, width, keep, F.struct("pos", "verbatim", F.coalesce("lists", F.array(none)).alias("lists")))

    def lines(e: Column) -> Column:
        start = F.concat((e["pos"] + 1).cast("string"), F.lit(". Event: "), e["verbatim"], F.lit("\n   Candidate PTs: "))
        shown = lambda c: F.when(F.size(c) > 0, F.array_join(c, "; ")).otherwise(F.lit(NO_CANDIDATES))
        return F.array_sort(F.array_distinct(F.transform(e["lists"], lambda c: F.concat(start, shown(c)))))

    joined = F.array_join(F.flatten(F.transform("entries", lines)), "\n")
    return grouped.select("kept.*", F.concat(F.lit(CODE_HEADER), joined).alias("input_text"))


def case_summary(case: Column, coded: Column | None = None) -> Column:
    """Text an assessor reads: patient, products, coded terms or verbatims, dates, history."""
    products = F.transform(
        case["products"], lambda p: F.concat(p["name"], F.lit(" ["), p["role"], F.lit("]"))
    )
    verbatims = F.concat(F.lit("Events: "), F.array_join(case["events"]["verbatim"], "; "))
    events = verbatims
    if coded is not None:
        terms = F.array_join(F.transform(coded, lambda c: c["meddra_pt"]), "; ")
        events = F.when(
            F.size(coded) > 0, F.concat(F.lit("Coded events (MedDRA PT): "), terms)
        ).otherwise(verbatims)
    history = case["medical_history"]
    return F.concat_ws(
        "\n",
        F.concat(
            F.lit("Patient: age "), _or_none(case["patient"]["age_years"]),
            F.lit(", sex "), case["patient"]["sex"],
        ),
        F.when(F.size(products) > 0, F.concat(F.lit("Products: "), F.array_join(products, "; "))),
        events,
        F.concat(
            F.lit("Vaccination date: "), _or_none(case["vaccination_date"]),
            F.lit("; onset: "), _or_none(case["onset_date"]),
            F.lit("; days to onset: "), _or_none(case["days_to_onset"]),
        ),
        F.when(F.size(history) > 0, F.concat(F.lit("History: "), F.array_join(history, "; "))),
    )


def assessment(cases: DataFrame) -> DataFrame:
    """Seriousness from the stated criteria, causality category from the time to onset."""
    days = F.col("extraction.case.days_to_onset")
    category = (
        F.when(days.isNull(), "unassessable")
        .when(days < 0, "unlikely")
        .when(days <= 2, "probable")
        .when(days <= 30, "possible")
        .otherwise("unlikely")
    )
    rationale = F.when(days.isNull(), F.lit("No onset timing stated.")).otherwise(
        F.concat(F.lit("Onset "), days.cast("string"), F.lit(" days after vaccination."))
    )
    criteria = F.col("stated.criteria")
    output = F.struct(
        F.struct((F.size(criteria) > 0).alias("serious"), criteria.alias("criteria_met")).alias(
            "seriousness"
        ),
        F.struct(
            F.lit("WHO-UMC").alias("method"), category.alias("category"),
            F.lit(None).cast("double").alias("score"), rationale.alias("rationale"),
        ).alias("causality"),
        F.when(days.isNull(), UNTIMED_CONFIDENCE).otherwise(TIMED_CONFIDENCE).alias("confidence"),
    )
    return cases.withColumn("assessment", output.cast(S.ASSESSMENT_OUTPUT))


def assembled_json(columns: list[str]) -> Column:
    """The structured case as one JSON text; a stage that did not run is null."""
    def part(name: str, path: str, stage: str) -> Column:
        return (F.col(path) if stage in columns else F.lit(None).cast("string")).alias(name)

    return F.to_json(
        F.struct(
            part("extracted", "extraction.case", "extraction"),
            part("coded", "coding.result", "coding"),
            part("seriousness", "assessment.seriousness", "assessment"),
            part("causality", "assessment.causality", "assessment"),
        ),
        {"ignoreNullFields": "false"},
    )


def _narrative(columns: list[str]) -> Column:
    case = F.col("extraction.case")
    age, sex = case["patient"]["age_years"], case["patient"]["sex"]
    onset, dose, days = case["onset_date"], case["vaccination_date"], case["days_to_onset"]
    patient = F.concat_ws(
        " ",
        F.when(age.isNotNull(), F.concat(age.cast("bigint").cast("string"), F.lit("-year-old"))),
        F.when(sex != "unknown", sex),
        F.lit("patient"),
    )
    products = F.array_join(
        F.transform(case["products"], lambda p: F.concat(p["name"], F.lit(" ("), p["role"], F.lit(")"))), ", "
    )
    events = F.array_join(case["events"]["verbatim"], ", ")
    if "coding" in columns:
        coded = F.transform(F.col("coding.result.coded"), lambda c: c["meddra_pt"])
        events = F.when(F.size(coded) > 0, F.array_join(coded, ", ")).otherwise(events)
    sentences = [
        F.concat(
            F.lit("A "), patient, F.lit(" received "),
            F.when(F.size(case["products"]) > 0, products).otherwise(F.lit("an unnamed product")),
            F.when(dose.isNotNull(), F.concat(F.lit(" on "), dose)).otherwise(F.lit("")), F.lit("."),
        ),
        F.when(F.size(case["events"]) > 0, F.concat(F.lit("Events reported were: "), events, F.lit("."))),
        F.when(onset.isNotNull(), F.concat(F.lit("Onset was "), onset, F.lit("."))),
        F.when(days.isNotNull(), F.concat(F.lit("Time to onset was "), days.cast("string"), F.lit(" days."))),
    ]
    if "assessment" in columns:
        criteria = F.col("assessment.seriousness.criteria_met")
        sentences += [
            F.when(
                F.size(criteria) > 0,
                F.concat(F.lit("The case was serious ("), F.array_join(criteria, ", "), F.lit(").")),
            ).otherwise(F.lit("The case was not serious.")),
            F.concat(F.lit("Causality was assessed as "), F.col("assessment.causality.category"), F.lit(".")),
        ]
    return F.concat_ws(" ", *sentences)


def narrative_qc(cases: DataFrame, threshold: float = S.HITL_THRESHOLD) -> DataFrame:
    """Past-tense narrative, completeness, quality flags and the review recommendation."""
    columns = cases.columns
    case, stated = F.col("extraction.case"), F.col("stated")
    no_age = case["patient"]["age_years"].isNull()
    no_sex = case["patient"]["sex"] == "unknown"
    no_onset = case["onset_date"].isNull()
    gaps = _texts(
        (no_age, "age"), (no_sex, "sex"), (F.size(case["products"]) == 0, "product"),
        (F.size(case["events"]) == 0, "event"),
        (case["vaccination_date"].isNull(), "vaccination_date"), (no_onset, "onset_date"),
    )
    gap_days = F.datediff(stated["onset_date"], stated["vaccination_date"])

    def flag(cond: Column, kind: str, severity: str, detail: Column) -> Column:
        return F.when(
            cond,
            F.struct(F.lit(kind).alias("type"), F.lit(severity).alias("severity"), detail.alias("detail")),
        )

    flags = [
        flag(no_age, "missing_field", "warning", F.lit("age")),
        flag(no_sex, "missing_field", "warning", F.lit("sex")),
        flag(no_onset, "missing_field", "warning", F.lit("onset_date")),
        flag(gap_days < 0, "temporal_anomaly", "error", F.lit("onset before vaccination")),
        flag(
            stated["stated_days"] != gap_days, "inconsistency", "warning",
            F.lit("stated days to onset differ from the dates"),
        ),
    ]
    if "coding" in columns:
        result = F.col("coding.result")
        unsure = F.exists(result["coded"], lambda c: c["confidence"] < threshold)
        n_open = F.size(result["uncoded"])
        flags += [
            flag(unsure, "low_confidence_coding", "warning", F.lit("a coded term is uncertain")),
            flag(n_open > 0, "unmapped_event", "warning", F.concat(n_open.cast("string"), F.lit(" uncoded"))),
        ]
    work = cases.withColumn("_gaps", gaps).withColumn("_flags", F.array_compact(F.array(*flags)))
    errors = F.size(F.filter("_flags", lambda f: f["severity"] == "error"))
    warnings = F.size(F.filter("_flags", lambda f: f["severity"] == "warning"))
    work = work.withColumn("_errors", errors).withColumn(
        "_confidence", F.greatest(F.lit(0.0), F.round(1.0 - 0.3 * errors - 0.05 * warnings, 4))
    )
    output = F.struct(
        _narrative(columns).alias("narrative"),
        F.struct(
            F.round((6 - F.size("_gaps")).cast("double") / 6, 4).alias("completeness_score"),
            _strings(F.col("_gaps")).alias("gaps"),
        ).alias("completeness"),
        F.col("_flags").alias("qc_flags"),
        F.col("_confidence").alias("overall_confidence"),
        (
            (F.col("_errors") > 0) | (F.size("_gaps") >= MANY_GAPS) | (F.col("_confidence") < threshold)
        ).alias("hitl_recommended"),
    )
    return work.withColumn("narrative_qc", output.cast(S.NARRATIVE_OUTPUT)).drop(
        "_gaps", "_flags", "_errors", "_confidence"
    )
