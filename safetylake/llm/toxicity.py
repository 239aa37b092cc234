"""Toxicity: boosted trees over dense features of a text, with isotonic calibration.

The features are the density of words from two lexicons (a fixed list of insults, and word stems learned from
labelled documents), how often such a word stands near a second-person word, the shares of capitals,
punctuation and symbols, and the rate of disguised words (digits and signs for letters, stretched letters)
that read as lexicon words once undone. Trees are fitted on one part of a bounded sample of labelled
documents and the isotonic curve on the rest.

A stem (the first letters of words, or a whole word) is learned if, in toxic documents, its words follow many
different words and do so far more often than in the others; copies of one text repeat the same neighbours,
so a large group of copies teaches nothing.

Scoring is one pass over the documents without a shuffle; the model's size is bounded by its parameters.

Defined results: null and empty texts are scored like any other, with all features 0; without labels of both
kinds every score is the share of toxic labels (0.5 without any); repeated rows are scored each; a null
doc_id counts as held out; an empty table gives no rows; columns of the documents travel in a struct, so
their names cannot clash.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safetylake.llm import boosting
from safetylake.llm.common import boxed, held_out, text_of
from safetylake.llm.labelled import training_rows

SAMPLE = 8000  # labelled documents the trees, the curve and the lexicon are fitted on, about as many
LEARNED = 200  # stems of the learned lexicon, at most
STEM = (4, 8)  # letters of a stem
NEAR = 5  # words between a second-person word and a lexicon word
THRESHOLD = 0.5

# Fixed word lists: insults and second-person words of the four languages.
INSULTS = frozenset(
    "ass asshole bastard bitch clown coward creep crap cunt disgusting dumb dumbass fool freak fuck fucking garbage "
    "idiot idiotic idiots imbecile jerk liar loser losers lowlife moron moronic morons pathetic pig retard retarded "
    "scum scumbag shit shut slut stupid trash ugly vermin vile whore worthless "
    "abruti connard conne débile imbécile merde ordure pute salaud salope "
    "abschaum arschloch depp dreckig dummkopf hure idioten scheiße trottel wichser "
    "basura cabrón estúpido gilipollas idiota imbécil mierda puta asqueroso".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur thou tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch usted ustedes tú ti vosotros".split()
)
# Signs that stand for letters.
SIGNS = str.maketrans("013457@$!|", "oieastasil")
WORDS = re.compile(r"[^\W\d_]+")
DISGUISED = re.compile(r"[^\W\d_]+[013457@$!|*.]+[^\W\d_][\w@$!|*.]*|[@$][^\W\d_][\w@$!|*]*")
STRETCHED = re.compile(r"([^\W\d_])\1\1+")
NAMES = [
    "log_words", "hits", "hit_rate", "distinct_hits", "learned", "learned_rate", "near_second", "second_rate",
    "upper_share", "shouted", "marks_rate", "stops_rate", "symbol_rate", "digit_rate", "disguised", "disguised_hits",
]

_UPPER, _DIGIT, _MARK, _STOP, _SYMBOL, _LOWER = range(1, 7)
_TABLE = np.zeros(256, dtype=np.uint8)
for _b in range(33, 127):
    _c = chr(_b)
    _TABLE[_b] = (
        _UPPER if _c.isupper() else _LOWER if _c.islower() else _DIGIT if _c.isdigit() else _MARK if _c in "!?"
        else _STOP if _c in ".,;:'\"-()" else _SYMBOL
    )


def undisguised(word: str) -> str:
    """The word a disguise stands for: signs as letters, other signs dropped, stretches shortened."""
    plain = re.sub(r"[\W\d_]", "", word.lower().translate(SIGNS))
    return STRETCHED.sub(r"\1", plain)


def with_stem(words: set[str], stems: frozenset[str]) -> set[str]:
    """The words that begin with a stem."""
    lengths = range(STEM[0], STEM[1] + 1)
    return {w for w in words if any(w[:n] in stems for n in lengths)} if stems else set()


def features(text: str, learned: frozenset[str]) -> list[float]:
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    kinds = np.bincount(_TABLE[raw], minlength=7).tolist() if len(raw) else [0] * 7
    words = WORDS.findall(text)
    lowered = [w.lower() for w in words]
    present = set(lowered)
    n = max(1, len(words))
    insults, taught = present & INSULTS, with_stem(present, learned)
    hits = learned_hits = near = 0
    if insults or taught:
        places = [i for i, w in enumerate(lowered) if w in insults or w in taught]
        hits = sum(lowered[i] in insults for i in places)
        learned_hits = sum(lowered[i] in taught for i in places)
        if present & SECOND_PERSON:
            near = sum(not SECOND_PERSON.isdisjoint(lowered[max(0, i - NEAR) : i + NEAR + 1]) for i in places)
    disguised = DISGUISED.findall(text) if kinds[_DIGIT] or kinds[_MARK] or kinds[_SYMBOL] else []
    stretched = [w for w in present if STRETCHED.search(w)]
    undone = [undisguised(w) for w in [*disguised, *stretched]]
    undone = sum(w in INSULTS for w in undone) + len(with_stem(set(undone), learned))
    second = sum(w in SECOND_PERSON for w in lowered) if present & SECOND_PERSON else 0
    size = max(1, len(raw))
    return [
        float(np.log1p(len(words))), hits, hits / n, len(insults), learned_hits, learned_hits / n, near, second / n,
        kinds[_UPPER] / max(1, kinds[_UPPER] + kinds[_LOWER]), sum(w.isupper() and len(w) > 2 for w in words) / n,
        kinds[_MARK] / n, kinds[_STOP] / n, kinds[_SYMBOL] / n, kinds[_DIGIT] / size, len(disguised) / n, undone,
    ]


@dataclass
class Model:
    trees: boosting.Trees
    curve: boosting.Isotonic
    learned: frozenset[str]
    share: float | None = None  # score where nothing could be learned

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.share is not None:
            return np.full(len(x), self.share)
        raw = self.trees.log_odds(x)
        # a little of the uncalibrated probability keeps the order inside the curve's flat parts
        return 0.99 * self.curve(raw) + 0.01 / (1 + np.exp(-raw))


def learn_stems(rows: DataFrame, most: int = LEARNED, contexts: int = 8, ratio: float = 20.0) -> frozenset[str]:
    """Stems whose words follow many different words in toxic rows and ``ratio`` times fewer in others, per row."""
    sizes = rows.agg(F.sum("label").alias("toxic"), F.count("*").alias("n")).first()
    toxic, clean = sizes["toxic"] or 0, sizes["n"] - (sizes["toxic"] or 0)
    if not toxic or not clean:
        return frozenset()
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}]+)"), F.lit(1))
    pairs = (
        rows.select("label", words.alias("w"))
        .select("label", F.explode(F.arrays_zip(F.slice("w", 2, F.size("w")).alias("word"), F.col("w").alias("before"))).alias("p"))
        .select("label", "p.word", "p.before")
        .where("word is not null")
        .distinct()
    )
    by_word = pairs.groupBy("word").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c"))
    lengths = F.sequence(F.lit(STEM[0]), F.least(F.lit(STEM[1]), F.greatest(F.lit(STEM[0]), F.length("word"))))
    stems = F.explode(F.array_distinct(F.transform(lengths, lambda n: F.substring("word", F.lit(1), n))))
    by_stem = by_word.where(F.length("word") >= STEM[0]).select(stems.alias("stem"), "t", "c")
    by_stem = by_stem.groupBy("stem").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    strength = ((F.col("t") + 0.5) / toxic) / ((F.col("c") + 0.5) / clean)
    best = by_stem.where((F.col("t") >= contexts) & (strength >= ratio)).orderBy(F.desc("t"), "stem").limit(20 * most)
    evidence = {r["stem"]: r["t"] for r in best.collect()}
    # a stem that one longer stem explains gives way to it; then the shortest stands for its family
    longer = {stem[:-1] for stem, t in evidence.items() if t >= 0.98 * evidence.get(stem[:-1], t + 1)}
    chosen: set[str] = set()
    for stem in sorted(evidence.keys() - longer, key=lambda x: (len(x), -evidence[x], x)):
        if len(chosen) < most and not with_stem({stem}, frozenset(chosen)):
            chosen.add(stem)
    return frozenset(chosen)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    rows = training_rows(docs, labels, "toxic", sample)
    learned = learn_stems(rows)

    @F.pandas_udf("array<double>")
    def made(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: features(t, learned))

    found = rows.select(made("text").alias("x"), "label", (F.pmod(F.xxhash64("text"), F.lit(10)) < 3).alias("late")).collect()
    found.sort(key=lambda r: (r["label"], r["x"]))
    x = np.array([r["x"] for r in found]).reshape(-1, len(NAMES))
    y = np.array([r["label"] for r in found], dtype=float)
    late = np.array([r["late"] for r in found], dtype=bool)
    if not len(y) or y.min() == y.max():
        return Model(boosting.Trees(), boosting.Isotonic(x, x), learned, float(y.mean()) if len(y) else 0.5)
    if not 0 < y[~late].sum() < (~late).sum() or not 0 < y[late].sum() < late.sum():
        late[:] = False  # too few rows for two parts: the curve is fitted on the trees' own rows
    trees = boosting.fit_trees(x[~late], y[~late])
    on = late if late.any() else ~late
    return Model(trees, boosting.fit_isotonic(trees.log_odds(x[on]), y[on]), learned)


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """row (struct of the input columns) and score."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    model = learn(docs, labels, sample)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array([features(t, model.learned) for t in texts])), dtype=float)

    return boxed(docs).withColumn("score", score(text_of("row.text")))


def op7_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    found = scored(docs.select("doc_id", "text"), labels)
    return found.select("row.doc_id", held_out("row.doc_id").alias("held_out"), "score", predicted)
