"""The pruned index and the fitted vectors against all pairs."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from safetylake.operators import grounding
from safetylake.operators.postings import Postings, scaled
from safetylake.session import stage_table


def csr(vectors):
    starts = np.append(0, np.cumsum([len(v) for v in vectors]))
    slots = np.array([s for v in vectors for s in v], dtype=np.int64)
    return starts, slots, np.array([w for v in vectors for w in v.values()], dtype=float)


def all_pairs(terms, query, k):
    def dot(v):
        return sum(w * query[s] for s, w in v.items() if s in query and s >= 0)

    size = lambda v: math.sqrt(sum(w * w for w in v.values())) + 1e-9
    scores = [round(dot(v) / (size(v) * size(query)), 9) + 0.0 for v in terms]
    best = sorted(range(len(terms)), key=lambda i: (-scores[i], i))[:k]
    return best, [scores[i] for i in best]


vector = st.dictionaries(st.integers(-1, 12), st.sampled_from([-2.0, -1.0, 0.5, 1.0, 3.0]), max_size=6)


@given(st.lists(vector, min_size=1, max_size=40), vector, st.integers(1, 6))
@settings(max_examples=400, deadline=None)
def test_index_equals_all_pairs(terms, query, k):
    index = Postings(*csr(terms))
    starts, slots, weights = csr([query])
    unit = scaled(starts, weights)
    found = [index.search(slots, unit, k, 9)] + ([index.search_full([(slots, unit)], k, 9)[0]] if index.full else [])
    rows, scores = all_pairs(terms, query, k)
    for got, values in found:
        assert np.allclose(values, scores, atol=2e-9)
        assert got.tolist() == rows or np.ptp(np.array(scores) - values) > 0


def words(n, seed):
    """Invented terms of two to four words from a vocabulary with common and rare words."""
    rng = random.Random(seed)
    parts = ["".join(rng.choice("aeiou") if i % 2 else rng.choice("bcdfglmnprstv") for i in range(rng.randint(4, 9))) for _ in range(max(300, n // 10))]
    weights = [1 / (i + 1) ** 0.7 for i in range(len(parts))]
    return sorted({" ".join(rng.choices(parts, weights, k=rng.randint(2, 4))) for _ in range(n)})


def plain_model(terms):
    grams = {t: Counter(f" {t.upper()} "[i : i + 3] for i in range(max(1, len(t)))) for t in terms}
    df = Counter(g for c in grams.values() for g in c)
    n = len(terms)
    weight = {g: round(math.log((1 + n) / (1 + c)) + 1, 9) for g, c in df.items()}
    return grams, {g: i for i, g in enumerate(sorted(df))}, weight, round(math.log(1 + n) + 1, 9)


def plain_vector(term, slot, weight, other):
    grams = Counter(f" {term.upper()} "[i : i + 3] for i in range(max(1, len(term))))
    out = {slot[g]: n * weight[g] for g, n in grams.items() if g in slot}
    rest = math.sqrt(sum((n * other) ** 2 for g, n in grams.items() if g not in slot))
    size = math.sqrt(sum(w * w for w in out.values()) + rest * rest)
    if rest:
        out[-1] = rest
    return {s: w / size for s, w in out.items()}


def test_fitted_vectors_equal_a_plain_version(spark):
    terms = words(300, 1)
    _, slot, weight, other = plain_model(terms)
    frame = spark.createDataFrame([(t,) for t in [*terms, terms[0]]] + [(None,)], "pt_term string")
    model = stage_table(grounding.fit_vectors(frame, "pt_term"), "model")
    found = {r.gram: (r.slot, r.weight) for r in model.collect()}
    assert found.pop(None) == (-1, pytest.approx(other))
    assert {g: s for g, (s, _) in found.items()} == slot
    assert all(w == pytest.approx(weight[g], abs=2e-9) for g, (_, w) in found.items())
    for text in (terms[5], "zzz qqq xxx", "", terms[7] + " ZZQ"):
        frame = spark.createDataFrame([(text,)], "t string")
        got = grounding.embed_terms(frame, "t", model).first().vector
        expected = plain_vector(text, slot, weight, other)
        assert list(got.slots) == sorted(expected)
        assert list(got.weights) == pytest.approx([expected[s] for s in sorted(expected)], abs=2e-9)
    assert grounding.embed_terms(frame.limit(0), "t", model).count() == 0


def test_nearest_terms_equal_all_pairs_and_read_few(spark):
    terms = words(4000, 2)
    rng = random.Random(3)
    asked = [t[: (i := rng.randrange(1, len(t)))] + rng.choice("aeiou") + t[i + 1 :] for t in rng.sample(terms, 300)] + ["zzz", ""]
    grams, slot, weight, other = plain_model(terms)
    matrix = np.zeros((len(terms), len(slot)))
    for i, t in enumerate(terms):
        for s, w in plain_vector(t, slot, weight, other).items():
            matrix[i, s] = w
    queries = np.zeros((len(asked), len(slot)))
    for i, t in enumerate(asked):
        for s, w in plain_vector(t, slot, weight, other).items():
            if s >= 0:
                queries[i, s] = w
    exact = queries @ matrix.T
    frame = spark.createDataFrame([(t,) for t in asked], "verbatim string")
    dictionary = spark.createDataFrame([(t,) for t in terms], "pt_term string")
    found = {}
    for r in grounding.nearest_to(frame, dictionary, 5).orderBy("verbatim", "rank").collect():
        found.setdefault(r.verbatim, []).append((terms.index(r.pt_term), r.score))
    for i, t in enumerate(asked):
        best = sorted(exact[i], reverse=True)[:5]
        assert [s for _, s in found[t]] == pytest.approx(best, abs=1e-6)
        assert all(abs(exact[i][j] - s) < 1e-6 for j, s in found[t])
    vectors = [dict(zip(np.flatnonzero(row).tolist(), row[row > 0].tolist(), strict=True)) for row in matrix]
    index = Postings(*csr(vectors))
    assert not index.full
    postings = 0
    for row in queries:
        at = np.flatnonzero(row)
        index.search(at, row[at], 5, 9)
        postings += int((matrix[:, at] > 0).sum())
    assert index.scored < 0.03 * len(asked) * len(terms)
    assert index.touched < 0.6 * postings


def test_vectors_of_users_and_missing_ones(spark):
    rows = [("a", [1.0, 0.0]), ("b", [0.0, 0.0]), ("c", None), ("d", [-1.0, 2.0]), (None, None), ("a", [1.0, 0.0])]
    terms = spark.createDataFrame(rows, "pt_term string, vector array<float>")
    asked = spark.createDataFrame([("q", [1.0, 0.0]), ("n", None), ("z", [0.0, 0.0])], "verbatim string, vector array<double>")
    got = [tuple(r) for r in grounding.ground_topk(asked, terms, 3).orderBy("verbatim", "rank").collect()]
    assert [(v, r, t) for v, r, t, _ in got] == [("q", 1, "a"), ("q", 2, "b"), ("q", 3, "d"), ("z", 1, "a"), ("z", 2, "b"), ("z", 3, "d")]
    assert grounding.ground_topk(asked.limit(0), terms).count() == 0
