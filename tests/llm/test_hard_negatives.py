"""Hard negatives against all pairs."""

import math

import numpy as np
import pytest

from safetylake.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, bars string, nr string, anchor string"


def plain(rows, every=100, positives=5, negatives=5):
    """The result by all pairs, in whole numbers of any size."""
    kept = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.append((vec_id, [math.floor(256 * x) for x in vector], label))
    order = lambda t: (-t[0], t[1] is None, t[1] or 0)
    out = []
    for n, (vec_id, v, label) in enumerate(kept):
        if vec_id is None or vec_id % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=True)), i, k) for m, (i, w, k) in enumerate(kept) if m != n and len(w) == len(v)]
        for p, positive, _ in sorted((t for t in scored if t[2] == label), key=order)[:positives]:
            fit = [t for t in scored if t[2] != label and 80 * p <= 100 * t[0] <= 100 * p]
            for rank, (s, negative, _) in enumerate(sorted(fit, key=order)[:negatives], 1):
                out.append((vec_id, positive, rank, negative, p, s))
    return sorted(out, key=str)


def found(df):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).repartition(3)


def test_whole_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in vectors.collect()]
    expected = plain(rows)
    assert expected and found(hn.op12_hard_negatives(vectors)) == expected


@pytest.mark.parametrize("form", ["clusters", "equal", "short", "flat"])
def test_forms_of_vectors(spark, form, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 24))
    x = centres[rng.integers(0, 6, 900)] + 0.2 * rng.normal(size=(900, 24))
    if form == "equal":  # very many rows share one vector
        x[rng.random(900) < 0.4] = x[0]
    if form == "short":
        x = x[:, :3]
    if form == "flat":
        x = np.repeat(x[:, :4], 6, axis=1) * 0.1
    rows = [(i // 2 if i % 9 == 0 else i, x[i].tolist(), int(rng.integers(0, 4))) for i in range(900)]
    label = hn.F.when(hn.F.col("vec_id") % 7 == 0, (hn.F.col("label") + 1) % 10).otherwise(hn.F.col("label"))
    got = hn.hard_negatives(frame(spark, rows), hn.F.col("vec_id") % 100 == 0, label, block=4, chunk=200)
    assert found(got) == plain(rows)


def test_bounds_hold_and_rule_out():
    rng = np.random.default_rng(4)
    centres = rng.integers(-300, 300, size=(8, 4)).repeat(8, axis=1)
    v = centres[rng.integers(0, 8, 2000)] + rng.integers(-20, 20, size=(2000, 32))
    a, b = hn.Side(v[:50], np.zeros(50)), hn.Side(v[50:], np.zeros(1950))
    exact = v[:50] @ v[50:].T
    left = np.ones_like(exact, dtype=bool)
    best = np.sort(exact, axis=1)[:, -5][:, None]
    shares = []
    for (ma, da), (mb, db) in zip(a.levels, b.levels, strict=True):
        assert (np.abs(exact - ma @ mb.T) <= da @ db.T + 1e-3).all()
        left &= ma @ mb.T + da @ db.T + 1e-3 >= best
        shares.append(left.mean())
    assert shares[0] < 0.5 and shares[1] <= shares[0]
    full = np.full(50, -hn.LONG - 1)
    i, j, score = hn.candidates(a, b, full, np.full(50, hn.LONG), np.ones_like(exact, dtype=bool), 5)
    assert (score == exact[i, j]).all()
    for row in range(50):
        assert sorted(score[i == row])[-5:] == sorted(exact[row])[-5:]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (0, [0.5, 1.0], 1), (None, [1.0, 1.0], 1), (None, [1.0, 1.9], 2),
        (100, [1.0, 2.0], 2), (1, [1.0, nan], 1), (2, [1.0, None], 1), (3, None, 1), (4, [1.0, 1.0], None), (5, [inf, 1.0], 2),
        (6, [], 1), (200, [], 1), (8, [], 2), (9, [1.0, 2.0, 3.0], 1), (300, [1.0, 2.0, 3.0], 1), (11, [1.0, 2.0, 3.0], 3),
        (400, [0.0, 0.0], 3), (12, [0.0, 0.0], 3), (13, [-1.0, -2.0], 1), (14, [1e7, 1e7], 1), (500, [1e7, 3e6], 1), (15, [9e6, 5e6], 4),
    ]
    assert found(hn.op12_hard_negatives(frame(spark, rows))) == plain(rows)
    assert found(hn.op12_hard_negatives(frame(spark, rows).limit(0))) == []
    assert found(hn.op12_hard_negatives(frame(spark, rows[6:11]))) == []
    huge = [(0, [1e300, -1.0], 1), (1, [1e300, 1.0], 1), (2, [1e200, 1.0], 2)]  # at the ends of a long
    assert [r[4:] for r in found(hn.op12_hard_negatives(frame(spark, huge)))] == [(hn.LONG, hn.LONG)]
