"""Reference tables derived from raw reports: product scope, term dictionary, case slice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from safetylake import schemas as S


def product_scope(
    vax: DataFrame,
    vax_type: str,
    vax_manu: str | None = None,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Products of one family that the scope table does not list yet.

    ``existing`` names are dropped with a null-safe anti join, so repeating the derivation adds
    nothing and a NULL name there does not hold back other products.
    """
    wanted = F.col("vax_type") == vax_type
    if vax_manu:
        wanted = wanted & (F.col("vax_manu") == vax_manu)
    products = (
        vax.filter(wanted)
        .groupBy("vax_type", "vax_name")
        .agg(F.min("vax_manu").alias("vax_manu"))
    )
    if existing is not None:
        known = existing.select(F.col("vax_name").alias("known_name"))
        products = products.join(known, F.col("vax_name").eqNullSafe(F.col("known_name")), "left_anti")
    return products.select(
        F.lit(f"{vax_type} family").alias("scope_label"),
        "vax_type",
        "vax_name",
        "vax_manu",
        F.lit(True).alias("in_scope"),
        F.lit("auto-derived").alias("notes"),
    )


def in_scope_cases(vax: DataFrame, scope: DataFrame) -> DataFrame:
    """Distinct ids of cases with at least one in-scope product."""
    names = scope.filter("in_scope").select("vax_name")
    return vax.select("vaers_id", "vax_name").join(names, "vax_name", "left_semi").select(
        "vaers_id"
    ).distinct()


def pt_dictionary(
    symptoms_long: DataFrame, scope_cases: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """Terms coded on in-scope cases with their frequency, minus terms already listed."""
    # Count per case and term first: a case or term that is very frequent then reaches the
    # join as one row per (case, term) and not as its raw rows.
    per_case = symptoms_long.groupBy("vaers_id", "pt_term").agg(
        F.count(F.lit(1)).alias("n"), F.min("meddra_version").alias("version")
    )
    terms = (
        per_case.join(scope_cases, "vaers_id", "left_semi")
        .groupBy("pt_term")
        .agg(F.sum("n").alias("occurrence_count"), F.min("version").alias("version"))
    )
    if existing is not None:
        terms = terms.join(existing.select("pt_term"), "pt_term", "left_anti")
    return terms.select(
        "pt_term",
        F.col("version").cast("string").alias("meddra_version"),
        "occurrence_count",
        F.lit(False).alias("indexed_in_vector_search"),
    )


def case_slice(
    raw: DataFrame, scope_cases: DataFrame, min_chars: int = S.MIN_NARRATIVE_CHARS
) -> DataFrame:
    """In-scope cases with a narrative of at least ``min_chars`` characters."""
    return (
        raw.select("vaers_id", "symptom_text", "recvdate")
        .filter(F.char_length("symptom_text") >= min_chars)
        .join(scope_cases, "vaers_id", "left_semi")
    )


def foundation_counts(scope: DataFrame, dictionary: DataFrame, sliced: DataFrame) -> DataFrame:
    """One row: in-scope products, dictionary terms, slice cases."""

    def tally(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("what"), F.lit(1).alias("one"))

    def total(name: str) -> Column:
        return F.count(F.when(F.col("what") == name, 1)).alias(name)

    rows = (
        tally(scope.filter("in_scope"), "in_scope_products")
        .unionAll(tally(dictionary, "meddra_pts"))
        .unionAll(tally(sliced, "demo_slice_cases"))
    )
    return rows.agg(total("in_scope_products"), total("meddra_pts"), total("demo_slice_cases"))


def pt_list(dictionary: DataFrame) -> DataFrame:
    """Terms from most to least frequent."""
    return dictionary.select("pt_term", "occurrence_count").orderBy(
        F.col("occurrence_count").desc(), "pt_term"
    )


def case_pick(sliced: DataFrame, n: int = S.SLICE_SIZE) -> DataFrame:
    """The first ``n`` slice cases by id."""
    return sliced.orderBy("vaers_id").limit(n)

