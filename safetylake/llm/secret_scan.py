"""Secret scans: fixed patterns, and a randomness test battery with false-discovery control.

The patterns (assign, access, hex) give the base spans. The battery adds spans of kind ``random``: every run
of 20 or more token characters is a candidate ("=" is only padding at its end, so a value after a name is a
run of its own), its encoding is inferred from its alphabet, and three tests are taken: chi-squared
uniformity over that alphabet, runs of character classes, and serial correlation of successive symbols.
Two things are asked of a candidate:

* ordinary text would hardly look that even and that mixed: the tail probabilities of the chi-squared and
  the runs statistic under a model of words are combined (Fisher) into ``p``; the largest p that keeps the
  expected share of false finds below ``rate`` is taken over all candidates of all documents
  (Benjamini-Hochberg), apart for each band of lengths, since short strings carry little evidence;
* a uniform source would not look less random than that: the uniform tail probabilities of all three tests
  are combined and must be at least ``floor`` (this drops repeats, counters and alphabets in order).

The first pass counts p-values in bins, so what is gathered is one count per band and bin at any size; the
second pass finds spans. Rows that cannot hold any span are told by a regular expression in the JVM and do
not go through Python. Nothing is shuffled but those counts.

Defined results: null and empty texts have no spans; repeated rows are separate rows; a null doc_id stays
null; an empty table gives no rows; input columns travel in a struct, so their names cannot clash.
Numbers written in decimal digits alone are never candidates.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from safetylake.llm.common import boxed, text_of

KINDS = ("assign", "access", "hex", "random")
# Fixed patterns of the base kinds.
KEYWORD = "password|passwd|secret|token|api_?key"
ASSIGN = re.compile(rf"""(?ai:{KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

SHORTEST = 20
# "=" is padding at the end of a run; elsewhere it parts a name from its value.
LONG_RUN = rf"[A-Za-z0-9+/_-]{{{SHORTEST}}}"
CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_-]){LONG_RUN}[A-Za-z0-9+/_-]*(?:={{1,6}}(?![A-Za-z0-9+/_=-]))?")
POSSIBLE = rf"(?i:{KEYWORD})|AKIA|[0-9a-f]{{32}}|{LONG_RUN}"
BANDS = (20, 32, 64)
BINS_PER_DECADE, LAST_BIN = 10, 400
RATE, FLOOR = 0.01, 1e-4

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Alphabets of encodings, narrowest first, and the unevenness of words written in them: the sum over symbols
# of (share - 1/size)^2 * size. Each is below what word lists of the usual languages show.
ENCODINGS = [
    ("hex", DIGITS + "abcdef", 0.7), ("HEX", DIGITS + "ABCDEF", 0.7), ("base32", UPPER + "234567", 0.8),
    ("lower36", LOWER + DIGITS, 1.0), ("upper36", UPPER + DIGITS, 1.0), ("base62", DIGITS + LOWER + UPPER, 2.0),
    ("base64", UPPER + LOWER + DIGITS + "+/", 2.0), ("base64url", UPPER + LOWER + DIGITS + "-_", 2.0),
    ("any", UPPER + LOWER + DIGITS + "+/-_", 2.0),
]
WORD_CHANGES = 0.2  # most class changes per character that words and joined words show

Span = tuple[str, int, int]


def _upper_tail(z: float) -> float:
    return max(0.5 * math.erfc(z / math.sqrt(2)), 1e-300)


def _fisher(ps: list[float]) -> float:
    """Tail of the chi-squared law with 2 * len(ps) degrees of freedom at -2 * sum(log p)."""
    half = -sum(math.log(p) for p in ps)
    term = total = 1.0
    for k in range(1, len(ps)):
        term *= half / k
        total += term
    return max(min(1.0, math.exp(-half) * total), 1e-300)


def _class(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2


def battery(text: str) -> tuple[float, float]:
    """(probability under words, probability under a uniform source), both combined over the tests."""
    body = text.rstrip("=")
    present = set(body)
    found = next(((a, u) for _, a, u in ENCODINGS if present <= set(a)), None)
    if found is None or len(body) < SHORTEST or body.isdigit():
        return 1.0, 0.0
    alphabet, uneven = found
    n, k = len(body), len(alphabet)
    chi = k / n * sum(v * v for v in Counter(body).values()) - n
    df = k - 1
    spread = math.sqrt(2 * df * (n - 1) / n)
    words_p = _upper_tail((df + (n - 1) * uneven - chi) / math.sqrt(2 * df + 4 * (n - 1) * uneven))
    even_p = _upper_tail((chi - df) / spread)

    kinds = [_class(c) for c in body if c.isalnum()]
    pairs = list(zip(kinds, kinds[1:], strict=False))
    changes = sum(a != b and (a, b) != (2, 1) for a, b in pairs)
    m = max(1, len(pairs))
    share = Counter(map(_class, filter(str.isalnum, alphabet)))
    total = sum(share.values())
    expected = sum(
        share[a] * share[b] / total**2 for a in share for b in share if a != b and (a, b) != (2, 1)
    )
    words_runs = _upper_tail((changes - 0.5 - m * WORD_CHANGES) / math.sqrt(m * WORD_CHANGES * (1 - WORD_CHANGES)))
    z = abs(changes - m * expected) / math.sqrt(m * expected * (1 - expected))
    even_runs = min(1.0, 2 * _upper_tail(z))

    place = {c: i for i, c in enumerate(alphabet)}
    x = [place[c] for c in body]
    mean = sum(x) / n
    var = sum((v - mean) ** 2 for v in x)
    serial = sum((a - mean) * (b - mean) for a, b in zip(x, x[1:], strict=False)) / var if var else 1.0
    even_serial = min(1.0, 2 * _upper_tail(abs(serial) * math.sqrt(n)))
    return _fisher([words_p, words_runs]), _fisher([even_p, even_runs, even_serial])


def base_spans(text: str) -> list[Span]:
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    return spans + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def outside(start: int, end: int, spans: list[Span]) -> Iterator[tuple[int, int]]:
    """What spans sorted by start leave of start..end."""
    for _, s, e in spans:
        if start < e and s < end:
            if s > start:
                yield start, s
            start = e
    if start < end:
        yield start, end


class Overlaps:
    """Base spans of a text by kind; those of one kind do not overlap, so the ones that meet a run are neighbours."""

    def __init__(self, text: str):
        self.kinds = [[s for s in base_spans(text) if s[0] == kind] for kind in KINDS]
        self.ends = [[e for _, _, e in spans] for spans in self.kinds]

    def of(self, start: int, end: int) -> list[Span]:
        found = []
        for spans, ends in zip(self.kinds, self.ends, strict=True):
            at = bisect.bisect_right(ends, start)
            while at < len(spans) and spans[at][1] < end:
                found.append(spans[at])
                at += 1
        return found


def runs(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of every candidate: a run, then the long parts of it outside base spans."""
    base = None
    for m in CANDIDATE.finditer(text):
        yield m.span()
        base = Overlaps(text) if base is None else base
        parts = outside(*m.span(), sorted(base.of(*m.span()), key=lambda s: s[1]))
        yield from ((s, e) for s, e in parts if (s, e) != m.span() and len(text[s:e].rstrip("=")) >= SHORTEST)


def band_of(start: int, end: int) -> int:
    return sum(end - start >= b for b in BANDS) - 1


def candidates(text: str) -> Iterator[tuple[int, int, int, int]]:
    """(start, end, band, bin) of runs that a uniform source could have made; bin counts -log10 p."""
    for start, end in runs(text):
        words, even = battery(text[start:end])
        if even >= FLOOR:
            yield start, end, band_of(start, end), min(LAST_BIN, int(-math.log10(words) * BINS_PER_DECADE))


def tested(text: str) -> list[int]:
    """Band of every candidate, whatever its tests say: the number of tests taken."""
    return [band_of(start, end) for start, end in runs(text)]


def spans_of(text: str, least_bin: dict[int, int]) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), sorted by start and kind; an added span may overlap base spans, but not lie in them."""
    order = lambda s: (s[1], KINDS.index(s[0]))
    base, known = sorted(base_spans(text), key=order), Overlaps(text)
    added: list[Span] = []
    for start, end, band, bin_ in candidates(text):
        if bin_ >= least_bin[band]:
            # runs come in order and do not overlap, nor do the parts of one: only the last can lie over this one
            near = sorted([*known.of(start, end), *added[-1:]], key=order)
            if any(outside(start, end, near)):
                added.append(("random", start, end))
    return base, sorted([*base, *added], key=order)


def _possible(text: Column) -> Column:
    """The text if it can hold any span, else null."""
    return F.when(text.rlike(POSSIBLE), text)


def least_bins(docs: DataFrame, rate: float = RATE) -> dict[int, int]:
    """Per band the first bin whose p-values keep the false discovery rate; counted over all documents."""

    @F.pandas_udf("array<int>")
    def counted(texts: pd.Series) -> pd.Series:
        # a test is coded band * 1000, a candidate band * 1000 + 1 + bin
        return texts.map(lambda t: [b * 1000 for b in tested(t)] + [b * 1000 + 1 + i for _, _, b, i in candidates(t)])

    found = (
        docs.select(_possible(text_of()).alias("text"))
        .where(F.col("text").rlike(LONG_RUN))
        .select(F.explode(counted("text")).alias("code"))
        .groupBy("code")
        .count()
        .collect()
    )  # at most len(BANDS) * (LAST_BIN + 2) rows
    counts = {r["code"]: r["count"] for r in found}
    out = {}
    for band in range(len(BANDS)):
        tests, above, out[band] = counts.get(band * 1000, 0), 0, LAST_BIN + 1
        for bin_ in range(LAST_BIN, -1, -1):
            above += counts.get(band * 1000 + 1 + bin_, 0)
            if above and tests * 10 ** (-bin_ / BINS_PER_DECADE) <= rate * above:
                out[band] = bin_
    return out


SPAN = "array<struct<kind:string,start:int,end:int>>"


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """row (struct of the input columns), base and spans (arrays of kind, start, end in code points)."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    least = least_bins(docs, rate)

    @F.pandas_udf(f"base {SPAN}, spans {SPAN}")
    def find(texts: pd.Series) -> pd.DataFrame:
        found = [spans_of(t, least) if t else ([], []) for t in texts]
        return pd.DataFrame({n: [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in x[i]] for x in found] for i, n in enumerate(("base", "spans"))})

    return boxed(docs).withColumn("found", find(_possible(text_of("row.text")))).select("row", "found.base", "found.spans")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every secret replaced by ``mark``; n_chars follows the text."""

    @F.pandas_udf("string")
    def replace(texts: pd.Series, spans: pd.Series) -> pd.Series:
        def one(text: str, found) -> str:
            out, at = [], 0
            for s in found:
                if s["end"] > at:
                    out += [text[at : s["start"]], mark] if s["start"] >= at else []
                    at = s["end"]
            return "".join([*out, text[at:]])

        return pd.Series([one(t, f) for t, f in zip(texts, spans, strict=True)])

    hit = F.size("spans") > 0
    found = scan(docs).withColumn("clean", F.when(hit, replace(F.when(hit, text_of("row.text")).otherwise(""), "spans")))
    changed = {
        "text": F.when(hit, F.col("clean")).otherwise(F.col("row.text")),
        "n_chars": F.when(hit, F.length("clean").cast("long")).otherwise(F.col("row.n_chars")),
    }
    return found.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op4_secret_scan(docs: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scan(docs).select(
        "row.doc_id", *[count(k) for k in KINDS[:3]], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
