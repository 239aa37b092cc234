"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line is good or bad. A line's features are its own counts and those of its neighbours; weights and
label transitions are fitted by gradient ascent on the conditional likelihood, on a bounded sample of
labelled documents. Labels are known for documents only: at first every line has its document's label;
then, once, the lines of a bad document that the fitted chain finds good are relabelled (all but the worst),
and the chain is fitted again. Forward-backward gives each line's probability of being good; weighted by line
length these make the document's quality, and a logistic curve on it the score.

Scoring is one pass over the documents without a shuffle; the model is a few dozen numbers.

Defined results: null and empty texts, and texts of line breaks alone, get the share of good documents in
the sample as score; without labels of both kinds every score is that share (0.5 without any); repeated
rows are scored each; a null doc_id counts as held out; an empty table gives no rows; columns of the
documents travel in a struct, so their names cannot clash.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safetylake.llm.common import boxed, held_out, text_of
from safetylake.llm.labelled import training_rows

SAMPLE = 4000  # labelled documents the chain is fitted on, about as many
SAMPLE_LINES = 300  # consecutive lines that fitting looks at in one document, from a hashed line on; scoring reads all
THRESHOLD = 0.3

# Classes of bytes; bytes beyond ASCII are parts of letters.
_KINDS = {"lower": 0, "upper": 1, "digit": 2, "space": 3, "stop": 4, "symbol": 5, "wide": 6}
_TABLE = np.full(256, _KINDS["wide"], dtype=np.uint8)
for _b in range(128):
    _c = chr(_b)
    _TABLE[_b] = _KINDS[
        "lower" if _c.islower() else "upper" if _c.isupper() else "digit" if _c.isdigit()
        else "space" if _c.isspace() or _b < 32 else "stop" if _c in ".,;:!?'\"-()" else "symbol"
    ]
OWN = 12  # features of a line


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features of every line, length of every line)."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    lines = text.split("\n")
    breaks = np.flatnonzero(raw == 10)
    starts, ends = np.append(0, breaks + 1), np.append(breaks, len(raw))
    kinds = _TABLE[raw]

    def per_line(marks: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(marks, dtype=np.int64))
        return (total[ends] - total[starts]).astype(float)

    lower, upper, digit, space, stop, symbol, wide = (per_line(kinds == k) for k in range(7))
    twice = np.zeros(len(raw), dtype=bool)
    twice[1:] = (raw[1:] == raw[:-1]) & (kinds[1:] >= _KINDS["stop"]) & (kinds[1:] <= _KINDS["symbol"])
    double = per_line(twice)
    words = np.array([len(w := x.split()) + 1j * len(set(w)) for x in lines])
    n_words, distinct = words.real, words.imag
    length = ends - starts
    size, count = np.maximum(length, 1), np.maximum(n_words, 1)
    letters = lower + upper + wide
    out = np.stack(
        [
            np.log1p(n_words), np.log1p(length), letters / size, upper / np.maximum(lower + upper, 1), digit / size,
            stop / count, symbol / count, double / count, distinct / count, np.minimum(letters / count, 20) / 10,
            (n_words > 3) * (distinct / count < 0.5), (length == 0).astype(float),
        ],
        axis=1,
    )
    return out, length.astype(float)


def with_neighbours(own: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after, marks of the first and last line, and 1."""
    n, width = own.shape
    out = np.zeros((n, 3 * width + 3))
    out[:, :width] = own
    out[1:, width : 2 * width] = own[:-1]
    out[:-1, 2 * width : 3 * width] = own[1:]
    out[0, -3] = out[-1, -2] = out[:, -1] = 1
    return out


def marginals(good: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) per line and the expected label moves (2, 2), by scaled forward-backward.

    ``good`` is each line's log-odds; ``moves[a, b]`` the log weight of label b after label a.
    """
    step = np.exp(moves - moves.max()).tolist()
    g = 1 / (1 + np.exp(-np.clip(good, -30, 30)))
    emit = [(1 - p, p) for p in g.tolist()]
    forward, scale = [], []
    for i, (bad, ok) in enumerate(emit):
        if i:
            f0, f1 = forward[-1]
            bad *= f0 * step[0][0] + f1 * step[1][0]
            ok *= f0 * step[0][1] + f1 * step[1][1]
        total = bad + ok
        forward.append((bad / total, ok / total))
        scale.append(total)
    b0 = b1 = 1.0
    probability = np.empty(len(emit))
    expected = [[0.0, 0.0], [0.0, 0.0]]
    for i in range(len(emit) - 1, -1, -1):
        f0, f1 = forward[i]
        probability[i] = f1 * b1 / (f0 * b0 + f1 * b1)
        if i:
            e0, e1 = emit[i][0] * b0 / scale[i], emit[i][1] * b1 / scale[i]
            p0, p1 = forward[i - 1]
            for a, before in ((0, p0), (1, p1)):
                expected[a][0] += before * step[a][0] * e0
                expected[a][1] += before * step[a][1] * e1
            b0, b1 = step[0][0] * e0 + step[0][1] * e1, step[1][0] * e0 + step[1][1] * e1
    return probability, np.array(expected)


@dataclass
class Chain:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    moves: np.ndarray
    curve: tuple[float, float]
    share: float  # score where there is nothing to read, and where nothing was learned

    def lines(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(P(good) per line, length per line)."""
        own, length = line_features(text)
        odds = with_neighbours((own - self.mean) / self.spread) @ self.weights
        return marginals(odds, self.moves)[0], length

    def score(self, text: str) -> float:
        if not len(self.weights) or not text.strip("\n"):
            return self.share
        good, length = self.lines(text)
        return float(_curve(_log_odds(np.average(good, weights=length)), self.curve))


def _log_odds(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _curve(x, curve: tuple[float, float]):
    return 1 / (1 + np.exp(-(curve[0] * x + curve[1])))


def _batched(docs: list[np.ndarray], weights: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of all lines (in order) and all expected moves, all documents at once, line by line."""
    sizes = np.array([len(d) for d in docs])
    order = np.argsort(-sizes, kind="stable")
    first = np.cumsum(sizes) - sizes
    odds = np.concatenate(docs) @ weights
    g = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    emit = np.stack([1 - g, g], axis=1)
    step = np.exp(moves - moves.max())
    forward, scale = np.empty_like(emit), np.empty(len(g))
    active = [order[sizes[order] > i] for i in range(sizes.max())]
    for i, some in enumerate(active):
        at = first[some] + i
        f = emit[at] * (forward[at - 1] @ step) if i else emit[at]
        scale[at] = f.sum(axis=1)
        forward[at] = f / scale[at, None]
    backward = np.ones_like(emit)
    expected = np.zeros((2, 2))
    for i in range(len(active) - 1, 0, -1):
        at = first[active[i]] + i
        e = emit[at] * backward[at] / scale[at, None]
        expected += step * (forward[at - 1].T @ e)
        backward[at - 1] = e @ step.T
    both = forward * backward
    return both[:, 1] / both.sum(axis=1), expected


def fit_weights(docs: list[np.ndarray], y: list[np.ndarray], rounds: int = 150, ridge: float = 1e-3):
    """(weights, moves) by gradient ascent with step sizes per weight (Adam)."""
    x, target = np.concatenate(docs), np.concatenate(y).astype(float)
    seen = np.zeros((2, 2))
    for labels in y:
        np.add.at(seen, (labels[:-1], labels[1:]), 1)
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        weights, moves = theta[:-4], theta[-4:].reshape(2, 2)
        p, expected = _batched(docs, weights, moves)
        slope = np.append(x.T @ (target - p), (seen - expected).ravel()) / len(x) - ridge * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta = theta + 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


def fit_chain(texts: list[tuple[np.ndarray, np.ndarray]], labels: list[int]) -> Chain:
    """A chain for (features, lengths) of documents and their labels."""
    share = float(np.mean(labels)) if labels else 0.5
    if len(set(labels)) < 2:
        return Chain(np.zeros(0), np.ones(0), np.zeros(0), np.zeros((2, 2)), (1.0, 0.0), share)
    every = np.concatenate([own for own, _ in texts])
    mean, spread = every.mean(axis=0), every.std(axis=0) + 1e-6
    docs = [with_neighbours((own - mean) / spread) for own, _ in texts]
    y = [np.full(len(d), label) for d, label in zip(docs, labels, strict=True)]
    weights, moves = fit_weights(docs, y)
    p, _ = _batched(docs, weights, moves)
    parts = np.split(p, np.cumsum([len(d) for d in docs])[:-1])
    for lines, good, label in zip(y, parts, labels, strict=True):
        if not label:
            lines[(good > 0.5) & (np.arange(len(good)) != good.argmin())] = 1
    weights, moves = fit_weights(docs, y)
    p, _ = _batched(docs, weights, moves)
    parts = np.split(p, np.cumsum([len(d) for d in docs])[:-1])
    quality = _log_odds(np.array([np.average(g, weights=n + 1e-9) for g, (_, n) in zip(parts, texts, strict=True)]))
    target, a, b = np.array(labels, dtype=float), 1.0, 0.0
    for _ in range(50):  # Newton steps for the curve
        q = _curve(quality, (a, b))
        h = q * (1 - q) + 1e-6
        g = np.array([((target - q) * quality).sum() - 0.1 * a, (target - q).sum()])
        bend = np.array([[(h * quality**2).sum() + 0.1, (h * quality).sum()], [(h * quality).sum(), h.sum()]])
        a, b = np.array([a, b]) + np.clip(np.linalg.solve(bend, g), -1, 1)
    return Chain(mean, spread, weights, moves, (float(a), float(b)), share)


def sampled_lines(text: str, own: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most SAMPLE_LINES consecutive lines of a document, their place chosen by a hash of the text."""
    start = zlib.crc32(text.encode("utf-8", "replace")) % max(len(own) - SAMPLE_LINES + 1, 1)
    return own[start : start + SAMPLE_LINES], length[start : start + SAMPLE_LINES]


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain:
    """The chain fitted on a bounded sample; line features are made by the executors."""

    @F.pandas_udf("own array<double>, length array<double>")
    def features(texts: pd.Series) -> pd.DataFrame:
        made = [sampled_lines(t, *line_features(t)) for t in texts]
        return pd.DataFrame({"own": [o.ravel() for o, _ in made], "length": [n for _, n in made]})

    rows = training_rows(docs, labels, "quality", sample).where(F.length(F.trim("text")) > 0)
    found = sorted(rows.select(features("text").alias("f"), "label").collect(), key=lambda r: (r["label"], r["f"]["own"]))
    texts = [(np.array(r["f"]["own"]).reshape(-1, OWN), np.array(r["f"]["length"])) for r in found]
    return fit_chain(texts, [r["label"] for r in found])


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """row (struct of the input columns) and score."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    chain = learn(docs, labels, sample)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(chain.score).astype(float)

    return boxed(docs).withColumn("score", score(text_of("row.text")))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold."""
    return scored(docs, labels).where(F.col("score") >= threshold).select("row.*")


def op10_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    found = scored(docs.select("doc_id", "text"), labels)
    return found.select("row.doc_id", held_out("row.doc_id").alias("held_out"), "score", predicted)
