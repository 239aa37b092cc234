"""Ground truth that human coders and the report form give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from safetylake import schemas as S
from safetylake.functions import text

# report flag -> (ground-truth column, seriousness criterion), in form order
SERIOUSNESS_FLAGS = {
    "died": ("died", "death"),
    "l_threat": ("life_threatening", "life_threatening"),
    "hospital": ("hospitalized", "hospitalization"),
    "disable": ("disabled", "disability"),
    "birth_defect": ("birth_defect", "congenital_anomaly"),
}
DATE_FORMAT = "MMddyyyy"
LOAD_STAMPS = ("_ingested_at", "_load_batch_id")


def symptoms_long(symptoms: DataFrame) -> DataFrame:
    """One row per filled term slot: (vaers_id, pt_term, meddra_version), in one scan."""
    pairs = ", ".join(f"symptom{i}, symptomversion{i}" for i in range(1, S.SYMPTOM_SLOTS + 1))
    return symptoms.select(
        "vaers_id",
        F.expr(f"stack({S.SYMPTOM_SLOTS}, {pairs}) as (pt_term, meddra_version)"),
    ).filter(text.is_filled(F.col("pt_term")))


def gt_pt(long: DataFrame) -> DataFrame:
    """Distinct (case, normalised term, version)."""
    return long.select(
        "vaers_id", text.term_key(F.col("pt_term")).alias("pt_term"), "meddra_version"
    ).distinct()


def gt_term(long: DataFrame) -> DataFrame:
    """Distinct (case, normalised term)."""
    return long.select("vaers_id", text.term_key(F.col("pt_term")).alias("pt_term")).distinct()


def parse_date(c: Column | str, formats: tuple[str, ...] = (DATE_FORMAT,)) -> Column:
    """First format that fits; NULL for malformed text."""
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])


def _flag(name: str, null_as_false: bool) -> Column:
    met = F.col(name) == "Y"
    return F.coalesce(met, F.lit(False)) if null_as_false else met


def any_flag(null_as_false: bool = False) -> Column:
    """TRUE if any flag is 'Y'; else NULL if any flag is unknown (SQL three-valued OR)."""
    result = F.lit(False)
    for name in SERIOUSNESS_FLAGS:
        result = result | _flag(name, null_as_false)
    return result


def gt_case(
    raw: DataFrame,
    vax: DataFrame,
    terms: DataFrame,
    null_as_false: bool = False,
    date_formats: tuple[str, ...] = (DATE_FORMAT,),
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Case facts: demographics, parsed dates, seriousness and child-row counts.

    ``keep`` names further report columns to carry along. Both child tables are reduced to one row per case in a single aggregation, so the
    report table is joined once.
    """
    children = (
        vax.select("vaers_id", F.lit(1).alias("product"), F.lit(0).alias("pt"))
        .unionAll(terms.select("vaers_id", F.lit(0), F.lit(1)))
        .groupBy("vaers_id")
        .agg(F.sum("product").alias("n_products"), F.sum("pt").alias("n_coded_pts"))
    )
    flags = [
        _flag(name, null_as_false).alias(column) for name, (column, _) in SERIOUSNESS_FLAGS.items()
    ]
    return raw.join(children, "vaers_id", "left").select(
        "vaers_id",
        "age_yrs",
        "sex",
        "state",
        parse_date("vax_date", date_formats).alias("vax_date"),
        parse_date("onset_date", date_formats).alias("onset_date"),
        F.col("numdays").alias("days_to_onset"),
        parse_date("recvdate", date_formats).alias("received_date"),
        *flags,
        any_flag(null_as_false).alias("serious"),
        F.col("recovd").alias("recovered"),
        F.coalesce("n_products", F.lit(0)).alias("n_products"),
        F.coalesce("n_coded_pts", F.lit(0)).alias("n_coded_pts"),
        *keep,
    )


def gt_seriousness(raw: DataFrame, null_as_false: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Seriousness per case with the list of criteria met, in form order, and the report columns ``keep``."""
    met = [
        F.when(F.col(name) == "Y", F.lit(criterion))
        for name, (_, criterion) in SERIOUSNESS_FLAGS.items()
    ]
    return raw.select(
        "vaers_id",
        any_flag(null_as_false).alias("serious"),
        F.array_compact(F.array(*met)).alias("criteria_met"),
        *keep,
    )


def one_per_case(truth: DataFrame, *columns: str) -> DataFrame:
    """vaers_id and ``columns`` of one row per case: of the newest load where the load stamps were kept.

    Without the stamps (LOAD_STAMPS) the loads cannot be told apart and the largest values count.
    """
    stamps = [c for c in LOAD_STAMPS if c in truth.columns]
    if not stamps and len(columns) == 1:
        return truth.groupBy("vaers_id").agg(F.max(columns[0]).alias(columns[0]))
    facts = F.struct(*stamps, *columns)
    return truth.groupBy("vaers_id").agg(F.max(facts).alias("newest")).select("vaers_id", *[f"newest.{c}" for c in columns])


def latest_batch(raw: DataFrame, ids: tuple[str, ...] = ("vaers_id",)) -> DataFrame:
    """Rows of the newest load batch that holds each id (undoes repeated loads)."""
    newest = raw.groupBy(*ids).agg(
        F.max(F.struct("_ingested_at", "_load_batch_id")).alias("newest")
    )
    same = [raw[c].eqNullSafe(newest[c]) for c in ids]
    batch = F.struct(raw["_ingested_at"], raw["_load_batch_id"]) == newest["newest"]
    joined = same[0]
    for s in same[1:]:
        joined = joined & s
    return raw.join(newest, joined & batch, "left_semi")
