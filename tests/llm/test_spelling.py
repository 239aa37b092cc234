"""Spelling variants against all pairs."""

import re
import string
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from safetylake.llm import spelling

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_forms(n):
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    best = {w: min(((-n[x], x) for x in near[w]), default=None) for w in n}
    form = {w: b[1] if b and -b[0] >= 5 * n[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def plain(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return plain_forms({w: c for w, c in n.items() if c >= 5 and len(w) >= 6})


def found(docs):
    rows = [tuple(r) for r in spelling.op11_spelling(docs).select(*COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@given(st.lists(st.text("abc", max_size=6), min_size=1, max_size=30, unique=True))
@settings(max_examples=300, deadline=None)
def test_scan_finds_all_pairs_at_one_edit(words):
    words = sorted(words)
    pairs = [(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if i < j and one_edit(a, b)]
    assert sorted(spelling.scan(words)) == pairs


def test_whole_table(small):
    assert found(small) == plain(small.select("doc_id", "text").collect())


@pytest.mark.parametrize("limit", [1, 3, 256])
def test_frequent_parts_are_dealt_anew(spark, limit):
    middles = [a + b + c for a in "abcdé" for b in "abc" for c in ("", "x", "ab")]
    n = {w: 5 * 7 ** (i % 4) for i, w in enumerate(sorted({"prefixes" + m + "ending" for m in middles} | {"a" * 12, "a" * 13}))}
    rows = spelling.variant_forms(spark.createDataFrame(list(n.items()), "word string, n long"), limit=limit)
    assert {tuple(r) for r in rows.select(*COLUMNS).collect()} == plain_forms(n)


def test_odd_rows(spark, odd, none):
    assert found(odd) == plain(odd.select("doc_id", "text").collect())
    assert found(none) == set()
    long = "x" * 100_000
    rows = [(1, f"{long} {long}y {long}Y {long}y", "e")] * 5 + [(None, "Éclairs éclairs Éclair2Éclairs", None)] * 9
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string")
    assert found(docs) == plain(docs.select("doc_id", "text").collect())
