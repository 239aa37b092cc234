"""Rows of reports put together batch by batch: first mentions, facts tied to events and products, coded events."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from safetylake import schemas as S

# What a fact may belong to; a date belongs to the nearer of events and products.
LINKED = {"date": ("event", "product"), "outcome": ("event",), "dose": ("product",), "route": ("product",), "maker": ("product",)}
KINDS = [*LINKED, "event", "product", "sex", "reporter", "criterion"]  # "event" before "product", as in the alphabet
# Words that part what they stand between count as so many words of distance.
PARTED = 10
PAIRS = 1 << 21  # pairs of a fact and what it may belong to that are held at a time
SHIFT = 1 << 32  # a place of a report as one number: report * SHIFT + place

MENTIONS = T.ArrayType(T.StructType().add("pos", "integer").add("name", "string").add("verbatim", "string").add("in_scope", "boolean"))
LINKS = T.ArrayType(T.StructType().add("gap", "integer").add("pos", "integer").add("value", "string").add("kind", "string").add("name", "string"))


#: Columns of a report that ``gather`` returns, after its facts.
SCHEMA = (
    T.StructType()
    .add("facts", T.ArrayType(T.StringType()))
    .add("events", MENTIONS)
    .add("products", MENTIONS)
    .add("linked", T.StructType([T.StructField(fact, LINKS) for fact in LINKED]))
    .add("sex", "string")
    .add("has_reporter", "boolean")
    .add("criteria", T.ArrayType(T.StringType()))
)
# What a row is, in one number: -1 for the lead of a report, else 8 * (1 + its kind's place in KINDS) + these.
IN_SCOPE, END, PART = 4, 1, 2


def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per report from rows (facts, what, pos, n, name, verbatim).

    The rows of a report follow one another. The first alone has facts, texts that are passed through; the others are
    mentions, clause ends or parting words, as ``what`` says. Columns are few because Spark sizes each of them for every
    row. A batch is worked on as arrays; what is held is one batch and the report that reaches beyond it.
    """
    for whole in _whole(batches, lambda batch: batch.column("what").to_numpy() < 0):
        yield from _gathered(whole)


def _whole(batches: Iterator[pa.RecordBatch], leads: Callable[[pa.RecordBatch], np.ndarray]) -> Iterator[list[pa.RecordBatch]]:
    """The batches, cut where a row leads: what starts with a lead is given together with all rows that follow it."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        at = np.flatnonzero(leads(batch))
        if len(at):
            if waiting or at[-1]:
                yield [*waiting, batch.slice(0, at[-1])]
            waiting = [batch.slice(at[-1])]
        else:
            waiting.append(batch)
    if waiting:
        yield waiting


def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row (kept, entries) per case from rows (kept, leads, entry).

    The rows of a case follow one another and the first leads: its ``kept`` is passed through, the entries of all of
    them that are not null become a list in their order.
    """
    for whole in _whole(batches, lambda batch: batch.column("leads").to_numpy(zero_copy_only=False)):
        rows = pa.Table.from_batches(whole).combine_chunks()
        kept, leads, entry = (rows.column(c).combine_chunks() for c in ("kept", "leads", "entry"))
        leads = leads.to_numpy(zero_copy_only=False)
        told = np.flatnonzero(entry.is_valid().to_numpy(zero_copy_only=False))
        case, first = np.cumsum(leads) - 1, np.flatnonzero(leads)
        lists = _lists(case[told], len(first), entry.take(pa.array(told)))
        yield pa.RecordBatch.from_arrays([kept.take(pa.array(first)), lists], ["kept", "entries"])


def _ranked(column: pa.Array) -> np.ndarray:
    """A number for each text that grows with it, -1 for null."""
    found = column.dictionary_encode()
    texts = found.dictionary.to_pylist()
    rank = np.empty(len(texts) + 1, dtype=np.int64)
    rank[sorted(range(len(texts)), key=texts.__getitem__)] = np.arange(len(texts))
    rank[-1] = -1
    return rank[found.indices.fill_null(-1).to_numpy()]


def _coded(column: pa.Array, names: list[str]) -> np.ndarray:
    """The place of each text in ``names``; -1 for others and null."""
    found = column.dictionary_encode()
    place = np.array([*(names.index(t) if t in names else -1 for t in found.dictionary.to_pylist()), -1])
    return place[found.indices.fill_null(-1).to_numpy()]


def _lists(report: np.ndarray, n_reports: int, values: pa.Array) -> pa.ListArray:
    """One list per report of values that are in the order of reports."""
    ends = np.cumsum(np.bincount(report, minlength=n_reports))
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), values)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def _nearest(facts: dict[str, np.ndarray], targets: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fact, target, gap) of the facts that have a target in their clause.

    A mention is an interval of words. A fact belongs to the nearest interval of its clause by the number of words in
    between, where parting words count PARTED more; of equally near ones to the first, and of those that start together
    to the longest. ``targets`` are in the order of their clauses.
    """
    first = np.searchsorted(targets["clause"], facts["clause"], "left")
    sizes = np.searchsorted(targets["clause"], facts["clause"], "right") - first
    ends = np.cumsum(sizes)
    found, begin = [], 0
    while begin < len(sizes):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
        some = sizes[begin:end]
        f = np.repeat(np.arange(begin, end), some)
        t = np.arange(len(f)) + np.repeat(first[begin:end] - (np.cumsum(some) - some), some)
        pos, start = facts["pos"][f], targets["pos"][t]
        gap = np.maximum(0, np.maximum(pos - start - targets["n"][t], start - pos - facts["n"][f]))
        gap = gap + PARTED * np.abs(facts["part"][f] - targets["part"][t])
        order = np.lexsort((targets["name"][t], targets["kind"][t], -targets["n"][t], start, gap, f))
        best = order[_changes(f[order])]
        found.append((f[best], t[best], gap[best]))
        begin = end
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, dtype=np.int64),) * 3


def _gathered(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(batches).combine_chunks()
    if not rows:
        return
    column = {c: rows.column(c).combine_chunks() for c in rows.column_names}
    number = lambda c: column[c].fill_null(0).to_numpy().astype(np.int64)
    what, name, pos, n = number("what"), _ranked(column["name"]), number("pos"), number("n")
    leads = np.flatnonzero(what < 0)
    n_reports, report = len(leads), np.cumsum(what < 0) - 1
    place = report * SHIFT + pos
    clause_ends, parting = (np.unique(place[(what > 0) & (what & mark > 0)]) for mark in (END, PART))
    kind, in_scope = np.where(what < 0, -1, what // 8 - 1), what & IN_SCOPE > 0

    row = np.flatnonzero((kind >= 0) & (name >= 0))
    row = row[np.lexsort((n[row], pos[row], name[row], kind[row], report[row]))]
    row = row[_changes(report[row], kind[row], name[row], pos[row], n[row])]
    firsts = row[_changes(report[row], kind[row], name[row])]

    def of_kind(wanted: str) -> np.ndarray:
        """The first mentions of a kind in the order of the text."""
        some = firsts[kind[firsts] == KINDS.index(wanted)]
        return some[np.lexsort((name[some], pos[some], report[some]))]

    def mentions(wanted: str) -> pa.Array:
        some = of_kind(wanted)
        values = [pa.array(pos[some], pa.int32()), *(column[c].take(pa.array(some)) for c in ("name", "verbatim")), pa.array(in_scope[some])]
        return _lists(report[some], n_reports, pa.StructArray.from_arrays(values, MENTIONS.elementType.names))

    def placed(some: np.ndarray) -> dict[str, np.ndarray]:
        before = lambda marks: np.searchsorted(marks, report[some] * SHIFT + pos[some]) - np.searchsorted(marks, report[some] * SHIFT)
        of = {"row": some, "kind": kind[some], "name": name[some], "pos": pos[some], "n": n[some], "part": before(parting)}
        return of | {"clause": report[some] * SHIFT + before(clause_ends)}

    def linked(fact: str, allowed: tuple[str, ...]) -> pa.Array:
        facts = placed(row[kind[row] == KINDS.index(fact)])
        targets = placed(row[np.isin(kind[row], [KINDS.index(k) for k in allowed])])
        order = np.argsort(targets["clause"], kind="stable")
        targets = {c: values[order] for c, values in targets.items()}
        f, t, gap = _nearest(facts, targets)
        f, t = facts["row"][f], targets["row"][t]
        taken = lambda some: column["name"].take(pa.array(some))
        values = [pa.array(gap, pa.int32()), pa.array(pos[f], pa.int32()), taken(f), pa.array(KINDS).take(pa.array(kind[t])), taken(t)]
        return _lists(report[f], n_reports, pa.StructArray.from_arrays(values, LINKS.elementType.names))

    sexes = of_kind("sex")
    sexes = sexes[_changes(report[sexes])]
    sex = np.full(n_reports, -1)
    sex[report[sexes]] = sexes
    told = np.zeros(n_reports, dtype=bool)
    told[report[firsts[kind[firsts] == KINDS.index("reporter")]]] = True
    criteria = of_kind("criterion")
    listed = _coded(column["name"], list(S.SERIOUSNESS))[criteria]
    order = np.lexsort((listed, report[criteria]))
    order = order[listed[order] >= 0]
    yield pa.RecordBatch.from_arrays(
        [
            column["facts"].take(pa.array(leads)),
            mentions("event"),
            mentions("product"),
            pa.StructArray.from_arrays([linked(*pair) for pair in LINKED.items()], [*LINKED]),
            column["name"].take(pa.array(sex, mask=sex < 0)),
            pa.array(told),
            _lists(report[criteria[order]], n_reports, column["name"].take(pa.array(criteria[order]))),
        ],
        SCHEMA.names,
    )
