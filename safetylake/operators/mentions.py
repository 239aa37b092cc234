"""Dictionary terms and stated facts found in report narratives, in one pass over the text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from safetylake.functions import text
from safetylake.functions.lookup import lookup
from safetylake.operators.gathering import END, IN_SCOPE, KINDS, PART, SCHEMA, gather

# --- Fixed values: words that state a reporter, a sex or a seriousness criterion -----
LEXICON = {
    "reporter": {
        w: [w.upper()] for w in ("patient", "nurse", "physician", "pharmacist", "parent", "reporter")
    },
    "sex": {"male": ["MALE", "MAN", "BOY"], "female": ["FEMALE", "WOMAN", "GIRL"]},
    "criterion": {
        "death": ["DIED", "DEATH", "FATAL", "DECEASED"],
        "life_threatening": ["LIFE THREATENING"],
        "hospitalization": [
            "HOSPITALIZED", "HOSPITALISED", "HOSPITALIZATION", "HOSPITALISATION", "ADMITTED",
        ],
        "disability": ["DISABLED", "DISABILITY", "DISABLING"],
        "congenital_anomaly": ["CONGENITAL", "BIRTH DEFECT"],
        "other_medically_important": ["MEDICALLY IMPORTANT", "MEDICALLY SIGNIFICANT"],
    },
    "outcome": {
        "recovered": ["RECOVERED", "RESOLVED", "SUBSIDED"],
        "recovering": ["RECOVERING", "RESOLVING", "IMPROVED", "IMPROVING"],
        "not_recovered": ["ONGOING", "PERSISTED", "PERSISTING", "PERSISTS", "UNRESOLVED"],
        "recovered_with_sequelae": ["SEQUELAE"],
        "fatal": ["FATAL", "DIED"],
    },
    "route": {
        "intramuscular": ["INTRAMUSCULAR", "INTRAMUSCULARLY", "IM"],
        "subcutaneous": ["SUBCUTANEOUS", "SUBCUTANEOUSLY", "SC"],
        "intradermal": ["INTRADERMAL", "INTRADERMALLY"],
        "intranasal": ["INTRANASAL", "INTRANASALLY"],
        "oral": ["ORAL", "ORALLY"],
    },
    "dose": {
        **{
            str(n): [f"{word} DOSE", f"{n}{end} DOSE", f"DOSE {n}", f"DOSE NUMBER {n}"]
            for n, (word, end) in enumerate(
                zip("FIRST SECOND THIRD FOURTH FIFTH SIXTH SEVENTH".split(), "ST ND RD TH TH TH TH".split(), strict=True), 1
            )
        },
        "booster": ["BOOSTER", "BOOSTER DOSE"],
    },
}
# --- Fixed values: patterns of the other stated facts --------------------------------
# An age says so: "old", "y/o" or "aged"; a number of years alone is a duration.
AGE = r"(?i)(?:^|[^\d.])(\d+(?:\.\d+)?)[- ]?(years?|yrs?|months?|mos?|weeks?|wks?|days?)[- ]old\b"
AGE_SHORT = r"(?i)(?:^|[^\d.])(\d+(?:\.\d+)?)[- ]?y(?:\. ?|/)?o\b"
AGED = r"(?i)\baged?[: ]+(\d+(?:\.\d+)?)\b"
UNITS_A_YEAR = {"m": 12.0, "w": 52.0, "d": 365.0}  # by the first letter of the unit
DATE = r"(\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4})"
ONSET = r"(?i)\bonset\b[^0-9.]*" + DATE
STATED_DAYS = r"(?i)\b(\d+) days? (?:after|later|post)\b"
LISTS = {
    "concomitant_meds": r"(?i)\bconcomitant medications?: *([^.]*)",
    "medical_history": r"(?i)\bhistory: *([^.]*)",
    "allergies": r"(?i)\ballerg(?:y|ies): *([^.]*)",
}
# A date is one word; a sentence end is a word of its own.
WORD = r"\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|[\p{L}\p{N}]+|\||[.;:!?]+(?=\s|$)"
ENDS = list("|.;:!?")
# Words that part what they stand between inside a clause.
PARTING = ["AND", "THEN", "WHILE", "PLUS", "FOLLOWED"]
# What follows a negation in its clause, up to four words, is not stated. "Not recovered from" denies the
# recovery, not the event, and states that it goes on; a contrast ("but") ends the clause.
NEGATION = r"(?i)\b(?:no|not|nor|without|never|denied|denies|denying)\b"
DENIED = NEGATION + r"(?:[ \t]+[\p{L}\p{N}][\p{L}\p{N}'/-]*){1,4}"
ONGOING = r"(?i)\bnot[ \t]+(?:yet[ \t]+)?(recovered|resolved|subsided|improved|gone|better)\b"
CONTRAST = r"(?i)[ \t]+(but|however|although|except)\b"


# A pattern is tried only where its lower-case cue occurs in the text, which is far cheaper.
CUES = {
    "onset": "onset", "days": " day", "concomitant_meds": "concomitant", "medical_history": "history",
    "allergies": "allerg", "age": "old", "age_unit": "old", "aged": "age",
}
# The fields of ``stated_texts``.
STATED = ["age", "age_unit", "age_short", "aged", "dose", "onset", "days", *LISTS]
# Every way to write the "y/o" of an age holds one of these.
SHORT_CUES = ["yo", "y/o", "y.o", "y. o"]


def stated_texts(narrative: Column, lowered: Column) -> Column:
    """Struct of the text pieces that state age, dates, days and lists ('' when absent)."""

    def cued(name: str, pattern: str, group: int = 1) -> Column:
        found = F.regexp_extract(narrative, pattern, group)
        return F.when(F.contains(lowered, F.lit(CUES[name])), found).otherwise(F.lit("")).alias(name)

    without_onset = F.when(
        F.contains(lowered, F.lit(CUES["onset"])), F.regexp_replace(narrative, ONSET, " ")
    ).otherwise(narrative)
    short = reduce(Column.__or__, [F.contains(lowered, F.lit(cue)) for cue in SHORT_CUES])
    return F.struct(
        cued("age", AGE),
        F.lower(F.substring(cued("age_unit", AGE, 2), 1, 1)).alias("age_unit"),
        F.when(short, F.regexp_extract(narrative, AGE_SHORT, 1)).otherwise(F.lit("")).alias("age_short"),
        cued("aged", AGED),
        F.regexp_extract(without_onset, DATE, 1).alias("dose"),
        cued("onset", ONSET),
        cued("days", STATED_DAYS),
        *[cued(name, pattern) for name, pattern in LISTS.items()],
    )


def stated_date(c: Column) -> Column:
    # A format is tried only on text with its separator: each text that does not fit costs an exception.
    tried = lambda separator, form: F.when(F.contains(c, F.lit(separator)), F.try_to_date(c, form))
    return F.coalesce(tried("-", "yyyy-MM-dd"), tried("/", "M/d/yyyy"))


def stated_age(texts: Column | dict[str, Column]) -> Column:
    """Age in years: a number of years, months, weeks or days "old", else "y/o", else "aged"."""
    divisor = F.lit(1.0)
    for unit, n in UNITS_A_YEAR.items():
        divisor = F.when(texts["age_unit"] == unit, F.lit(n)).otherwise(divisor)
    number = lambda name: F.when(texts[name] != "", texts[name].try_cast("double"))
    return F.coalesce(F.round(number("age") / divisor, 4), number("age_short"), number("aged"))


def _items(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, "[;,]"), text.strip), lambda item: item != "")


def lexicon(spark: SparkSession) -> DataFrame:
    """The fixed words as vocabulary rows."""
    rows = [
        (phrase, kind, name, False)
        for kind, names in LEXICON.items()
        for name, listed in names.items()
        for phrase in listed
    ]
    return spark.createDataFrame(rows, "phrase string, kind string, name string, in_scope boolean")


def vocabulary(dictionary: DataFrame, products: DataFrame, scope: DataFrame) -> DataFrame:
    """Phrases to look for: dictionary terms, product names, makers and the fixed words.

    One row per (phrase, kind), with its number of words ``n`` and its anchor: of its pairs of neighbouring
    words the ``key`` that fewest phrases hold, and its ``offset``; a phrase of one word is its own key.
    ``dictionary`` holds pt_term, ``products`` vax_name and, where known, vax_manu, ``scope`` vax_name and in_scope.
    """

    def named(rows: DataFrame, column: str, kind: str) -> DataFrame:
        return rows.select(
            text.phrase_key(F.col(column)).alias("phrase"), F.lit(kind).alias("kind"), F.col(column).alias("name"), "in_scope"
        )

    listed = scope.filter("in_scope").select("vax_name").distinct().withColumn("in_scope", F.lit(True))
    names = products.select("vax_name").distinct().join(listed, "vax_name", "left")
    names = names.withColumn("in_scope", F.coalesce("in_scope", F.lit(False)))
    found = (
        named(dictionary.withColumn("in_scope", F.lit(False)), "pt_term", "event")
        .unionAll(named(names, "vax_name", "product"))
        .unionAll(lexicon(dictionary.sparkSession))
    )
    if "vax_manu" in products.columns:
        makers = products.select("vax_manu").distinct().withColumn("in_scope", F.lit(False))
        found = found.unionAll(named(makers, "vax_manu", "maker"))
    found = (
        found.filter(F.col("phrase") != "")
        .groupBy("phrase", "kind")
        .agg(F.min("name").alias("name"), F.max("in_scope").alias("in_scope"))
    )
    singles = F.split("phrase", " ")
    pairs = F.zip_with(singles, F.slice(singles, 2, F.size(singles)), lambda a, b: F.concat(a, F.lit(" "), b))
    keys = F.when(F.size(singles) == 1, singles).otherwise(F.array_compact(pairs))
    parts = found.select("phrase", "kind", F.size(singles).alias("n"), F.posexplode(keys).alias("offset", "key"))
    holders = parts.groupBy("key").agg(F.count_distinct("phrase").alias("holders"))
    anchors = (
        parts.join(holders, "key")
        .groupBy("phrase", "kind", "n")
        .agg(F.min(F.struct("holders", "offset", "key")).alias("anchor"))
        .select("phrase", "kind", "n", "anchor.key", "anchor.offset")
    )
    return found.join(anchors, ["phrase", "kind"])


def affirmed(narrative: Column, unrecovered: str = "| $1") -> Column:
    """The text without what it denies; a mark stands in its place, so no phrase spans the gap.

    ``unrecovered`` replaces a denied recovery, whose word is group 1.
    """
    clauses = F.regexp_replace(F.regexp_replace(narrative, ONGOING, unrecovered), CONTRAST, " | $1")
    kept = F.regexp_replace(clauses, DENIED, " | ")
    return F.when(F.rlike(narrative, F.lit(NEGATION)), kept).otherwise(narrative)


def words(narrative: Column) -> Column:
    """Words in text order; a sentence end is a word of its own, so no phrase spans it."""
    return F.regexp_extract_all(narrative, F.lit(WORD), 0)


def read_reports(reports: DataFrame, vocab: DataFrame, keep_text: bool = False) -> DataFrame:
    """Facts and dictionary mentions per report: run_id, vaers_id, facts, events, products, linked; the narrative if kept.

    ``reports`` holds run_id, vaers_id, narrative, received_date. Reports with the same run_id are copies
    of one another: they collapse before the shuffle that deals the texts by run_id. Every word and every pair
    of neighbours meets the phrases that it anchors in an equi-join, and only there is the rest of the phrase
    compared, so a word is two rows of the join whatever the lengths of phrases.
    A vocabulary below the session's broadcast limit is broadcast: the rows of a report then still follow one another
    and are put together as they pass, without a sort or an aggregation. A larger one is shuffled with the
    words; the matches are then dealt and sorted by run_id.
    What a text denies ("no fever") is no mention; stated numbers, dates and lists are read as written.
    ``linked`` ties facts to their event or product, see ``gathering``.
    """
    spark = reports.sparkSession
    lowered = reports.dropDuplicates(["run_id"]).withColumn("lowered", F.lower("narrative"))
    parting = [form(w) for w in PARTING for form in (str.upper, str.lower, str.capitalize)]
    texts = stated_texts(F.col("narrative"), F.col("lowered"))
    # All of them texts: one list is far cheaper to pass than a column for each.
    text_kept = ["narrative"] if keep_text else []
    told = ["run_id", "vaers_id", "received_date", "input_hash", *STATED, *text_kept]
    facts = F.array("run_id", "vaers_id", "received_date", F.sha2("narrative", 256), *[F.col(f"texts.{name}") for name in STATED], *text_kept)
    # Entry 0 of a report is its facts row. It carries a word no text can hold, different for
    # each report, so that it survives the left join and spreads evenly if that is shuffled.
    lead = F.array(F.concat(F.lit("|"), F.col("run_id")))
    sizes = vocab.agg(
        F.max("offset").alias("before"), F.max(F.col("n") - F.col("offset")).alias("after"),
        F.sum(F.length("phrase") + F.length("key") + F.length("name") + 64).alias("bytes"),
    ).first()
    before, after = sizes["before"] or 0, sizes["after"] or 1
    narrow = (sizes["bytes"] or 0) <= spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    # The list is a column of its own: the words then leave it one by one in generated code, and a report's
    # other columns are not copied for each of them.
    read = lowered.select("*", texts.alias("texts"), words(affirmed(F.col("narrative"), "| ongoing")).alias("tokens"))
    read = read.select("run_id", facts.alias("facts"), "tokens", F.concat(lead, "tokens").alias("runs"))
    pair = F.when(F.col("at") > 0, F.concat("word", F.lit(" "), F.get("tokens", F.col("at"))))  # the last word has none
    rows = (
        read.select("run_id", "facts", "tokens", F.posexplode_outer("runs").alias("at", "word"))
        .filter("word is not null")
        .select("run_id", "facts", "tokens", "at", F.posexplode(F.array("word", pair)).alias("side", "run"))
        .filter("run is not null")
    )
    is_lead, is_pair = F.col("at") == 0, F.col("side") == 1
    is_end, is_parting = F.substring("run", 1, 1).isin(ENDS), F.col("run").isin(parting)
    mark = F.when(is_lead | is_pair, F.lit(0)).when(is_end, F.lit(END)).when(is_parting, F.lit(PART)).otherwise(F.lit(0))
    is_date = F.col("kind").isNull() & ~is_lead & ~is_pair & (F.contains("run", F.lit("-")) | F.contains("run", F.lit("/")))
    kept = is_lead | F.col("kind").isNotNull() | (mark != 0) | is_date
    if narrow:
        near, near_from = F.col("tokens"), F.lit(1)
        joined = rows.join(F.broadcast(vocab), F.upper("run") == F.col("key"), "left")
    else:  # only the facts row takes the facts along, and a place takes the words that a phrase around it can hold
        near, near_from = F.col("near"), F.greatest(F.lit(1), F.col("at") - before)
        around = F.when(is_pair, F.slice("tokens", near_from, F.col("at") + after - near_from))
        rows = rows.select("run_id", F.when(is_lead, F.col("facts")).alias("facts"), "at", "side", "run", around.alias("near"))
        joined = rows.join(vocab, F.upper("run") == F.col("key"), "left")
        joined = joined.filter(kept).repartition("run_id").sortWithinPartitions("run_id", "at")
    start = F.col("at") - F.col("offset")
    inside = (start >= near_from) & (start - near_from + F.col("n") <= F.size(near))
    whole = F.when(inside, F.array_join(F.slice(near, F.greatest(start - near_from + 1, F.lit(1)), F.col("n")), " "))
    verbatim = F.when(F.col("n") <= 2, F.col("run")).otherwise(whole)
    date = F.date_format(stated_date(F.col("run")), "yyyy-MM-dd")
    place = F.when(is_date, F.lit(KINDS.index("date") + 1)).otherwise(lookup(F.col("kind"), {k: i for i, k in enumerate(KINDS, 1)}))
    what = 8 * F.coalesce(place, F.lit(0)) + F.when(F.col("in_scope"), F.lit(IN_SCOPE)).otherwise(F.lit(0)) + mark
    matched = (
        joined.filter(kept)
        .filter(F.coalesce(F.col("n") <= 2, F.lit(True)) | (F.upper(verbatim) == F.col("phrase")))
        .select(
            F.when(is_lead, F.col("facts")).alias("facts"),
            F.when(is_lead, F.lit(-1)).otherwise(what).alias("what"),
            F.coalesce(start, F.col("at")).alias("pos"),
            F.coalesce("n", F.lit(1)).alias("n"),
            F.when(is_date, date).otherwise(F.col("name")).alias("name"),
            F.when(F.col("kind").isin("event", "product"), verbatim).alias("verbatim"),
        )
    )
    facts = [F.get("facts", F.lit(i)).alias(name) for i, name in enumerate(told)]
    gathered = matched.mapInArrow(gather, SCHEMA).select(*facts, *SCHEMA.names[1:])
    texts = {name: F.col(name) for name in STATED}
    stated = F.struct(
        stated_age(texts).alias("age_years"),
        "sex",
        "has_reporter",
        "criteria",
        stated_date(texts["dose"]).alias("vaccination_date"),
        stated_date(texts["onset"]).alias("onset_date"),
        texts["days"].try_cast("bigint").alias("stated_days"),
        *[_items(texts[name]).alias(name) for name in LISTS],
    )
    return gathered.select(
        "run_id", "vaers_id", "received_date", "input_hash", stated.alias("stated"), "events", "products", "linked", *text_kept
    )


def linked_value(fact: str, kind: str, name: Column) -> Column:
    """The value of the nearest ``fact`` tied to an event or product; NULL if there is none."""
    own = F.filter(F.col(f"linked.{fact}"), lambda x: (x["kind"] == kind) & (x["name"] == name))
    return F.array_min(own)["value"]


def with_run_id(reports: DataFrame, version: str) -> DataFrame:
    """Report rows with an id made of their content and the pipeline version.

    A retried task, a lost executor or a repeated load gives the same id again.
    """
    content = F.concat_ws("|", "vaers_id", F.lit(version), "received_date", F.sha2("narrative", 256))
    return reports.select(
        F.sha2(content, 256).alias("run_id"), "vaers_id", "narrative", "received_date"
    )
