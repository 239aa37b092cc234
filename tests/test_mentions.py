"""Phrases found by their anchors, and facts tied to events and products."""

import random

import pytest

from safetylake.operators import mentions, stages


def read(spark, texts, terms, products=(), scope=()):
    dictionary = spark.createDataFrame([(t, "24.0") for t in terms] or [("none such", "24.0")], "pt_term string, meddra_version string")
    names = spark.createDataFrame([*products] or [(None, None)], "vax_name string, vax_manu string")
    listed = spark.createDataFrame([(n, True) for n in scope] or [(None, True)], "vax_name string, in_scope boolean")
    vocab = mentions.vocabulary(dictionary, names, listed)
    reports = spark.createDataFrame([(str(i), str(i), t, None) for i, t in enumerate(texts)], "run_id string, vaers_id string, narrative string, received_date string")
    return mentions.read_reports(reports, vocab)


def cases(spark, *args):
    rows = stages.extraction(read(spark, *args)).orderBy("run_id").select("extraction.case").collect()
    return [
        (
            {p.name: (p.manufacturer, p.dose_series, p.route) for p in r.case.products},
            {e.verbatim: (e.onset_date, e.outcome) for e in r.case.events},
        )
        for r in rows
    ]


def test_two_products_and_three_events_in_one_sentence(spark):
    text = (
        "She got the second dose of FLU (X) by Alpha Labs intramuscularly and MMR from Beta orally, "
        "then rash on 2024-03-02 resolved while acute chest pain since 3/4/2024 is ongoing and chills on 2024-03-05."
    )
    ((products, events),) = cases(
        spark, [text], ["Rash", "Acute chest pain", "Chest pain", "Chills"], [("FLU (X)", "Alpha Labs"), ("MMR", "Beta")]
    )
    assert products == {"FLU (X)": ("Alpha Labs", "2", "intramuscular"), "MMR": ("Beta", None, "oral")}
    assert events["rash"] == ("2024-03-02", "recovered")
    assert events["acute chest pain"] == ("2024-03-04", "not_recovered")
    assert events["chest pain"] == (None, None)  # the longer mention takes the facts
    assert events["chills"] == ("2024-03-05", None)


def test_facts_stay_inside_their_clause(spark):
    texts = [
        "Rash. Onset 2024-03-02. Resolved.",
        "Rash on 2024-02-30.",
        "He got MMR on 2024-03-01 and rash.",
        "Has not recovered from rash.",
        "No rash on 2024-03-01; chills on 2024-03-04.",
        "Rash on 2024-03-01. Rash again, resolved on 2024-03-09.",
        "",
    ]
    found = cases(spark, texts, ["Rash", "Chills"], [("MMR", "Beta")])
    assert [e for _, e in found] == [
        {"Rash": (None, None)},
        {"Rash": (None, None)},
        {"rash": (None, None)},  # the date is nearer to the product
        {"rash": (None, "not_recovered")},
        {"chills": ("2024-03-04", None)},
        {"Rash": ("2024-03-01", "recovered")},  # the nearest of its mentions' dates
        {},
    ]


def test_phrases_equal_a_plain_search(spark):
    rng = random.Random(5)
    words = ["ab", "b", "cd", "dose", "e5", "ü", "one", "of"]
    terms = sorted({" ".join(rng.choices(words, k=rng.choice([1, 2, 3, 6]))) for _ in range(60)})
    texts = [" ".join(rng.choices([*words, ".", "x"], k=rng.randint(0, 60))) for _ in range(80)]
    for r in read(spark, texts, terms).collect():
        tokens = texts[int(r.run_id)].split()
        runs = {" ".join(tokens[i : i + n]) for i in range(len(tokens)) for n in (1, 2, 3, 6) if i + n <= len(tokens)}
        assert {e.name for e in r.events} == runs & set(terms)
        for e in r.events:
            n = len(e.name.split())
            first = next(i for i in range(len(tokens)) if tokens[i : i + n] == e.name.split())
            assert (e.pos, e.verbatim) == (first + 1, e.name)


def test_anchors_are_the_rarest_pairs(spark):
    dictionary = spark.createDataFrame([("Pain in arm",), ("Pain in leg",), ("Pain",), (None,), ("--",)], "pt_term string")
    empty = spark.createDataFrame([], "vax_name string, in_scope boolean")
    rows = mentions.vocabulary(dictionary, empty.select("vax_name"), empty).filter("kind = 'event'")
    assert {(r.phrase, r.key, r.offset, r.n) for r in rows.collect()} == {
        ("PAIN IN ARM", "IN ARM", 1, 3), ("PAIN IN LEG", "IN LEG", 1, 3), ("PAIN", "PAIN", 0, 1),
    }


@pytest.mark.parametrize("copies", [1, 3])
def test_very_long_reports_are_read_whole(spark, copies):
    text = "filler words here. " * 20_000 + "Rash on 2024-03-02 resolved."
    (found, *_) = cases(spark, [text] * copies, ["Rash"], [])
    assert found[1] == {"Rash": ("2024-03-02", "recovered")}

