"""Quality classifier from preference pairs (Bradley-Terry).

Every labelled good text is preferred to every labelled bad one. A document's strength is linear in measures of its text;
the weights minimise the logistic loss on differences of the measures of a pair. At most ``SAMPLE`` labelled documents of
either class take part, those with the smallest hash of their doc_id, and each is compared with at most ``RIVALS`` of the
other class. The threshold is a quantile of the strengths of all labelled documents that are not held out, from histograms of
``BINS`` strengths: the one with the best balanced accuracy. A score is the logistic function of the strength, shifted so that
the threshold gets ``CUT``.

Only the text is an input of a score: doc_id decides which labels are held out (and drawn), lang and source are not read.

Nulls: a null text is empty and is scored as such; a null doc_id is scored, counts as not held out and finds no label.
Labels that are null or contradict each other for a document are left out; repeated labels count once. Of several texts with
one labelled doc_id the smallest is learned from. Extra columns
are ignored by :func:`scored` and carried along by :func:`kept_documents`. Empty tables give no rows; without labels of both
classes every score is one half.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlog.llm.common import saved, small, texts_of

#: Labelled documents of a class, and comparisons of each; with the number of measures they bound the driver's work.
SAMPLE, RIVALS = 6_000, 24
#: Cuts that are tried for the threshold.
BINS = 2_000
#: The score of the threshold.
CUT = 0.3
#: Strength of the pull of weights towards 0.
RIDGE = 1e-3

_UPPER, _LOWER, _DIGIT = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"
_SYMBOLS = b"#*$%&|<>=@^~_\\/{}[]+"
_SENTENCE = re.compile(r"[.!?](?=\s|$)")


def measures(text: str) -> list[float]:
    """What a strength is made of; lengths as logarithms, the others as shares."""
    raw = text.encode()
    words, lines = text.split(), [line for line in text.split("\n") if line.strip()]
    n, size, n_lines = len(words), max(1, len(raw)), max(1, len(lines))
    some = max(1, n)
    of = lambda drop: (len(raw) - len(raw.translate(None, drop))) / size
    common = Counter(words).most_common(1)
    return [
        np.log1p(n), np.log1p(len(raw)), (len(text) - n) / some, of(_UPPER), of(_LOWER), of(_DIGIT), of(_SYMBOLS),
        of(b"|"), of(b"!"), of(b"#"), of(b"*$%&"), of(b".,;:"), of(b"'\"()-"), len(set(words)) / some,
        len(set(zip(words, words[1:]))) / some, sum(map(eq, words, words[1:])) / some, common[0][1] / some if common else 0.0,
        len(set(lines)) / n_lines, np.log1p(n / n_lines), len(_SENTENCE.findall(text)) / some,
        sum(map(str.isupper, words)) / some, sum(map(str.istitle, words)) / some, sum(map(str.isalpha, words)) / some,
    ]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Strength:
    """Standardised measures, their squares, and weights; a strength is their product."""

    def __init__(self, middle, spread, weights, threshold: float):
        self.middle, self.spread, self.weights, self.threshold = middle, spread, weights, threshold

    def terms(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.middle) / self.spread, -6, 6)
        return np.hstack([z, z * z / 3])

    def strengths(self, texts) -> np.ndarray:
        x = np.array([measures(t) for t in texts]).reshape(len(texts), -1)
        return self.terms(x) @ self.weights if self.weights is not None and len(texts) else np.zeros(len(texts))

    def score(self, strengths: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(strengths), 0.5)
        shift = np.log(CUT / (1 - CUT))
        value = np.clip(strengths - self.threshold + shift, -500, 500)
        score = 1 / (1 + np.exp(-value))
        return np.where(value >= shift, np.maximum(score, CUT), np.minimum(score, np.nextafter(CUT, 0)))


def fit(good: np.ndarray, bad: np.ndarray, steps: int = 30) -> Strength:
    """Newton's method for the pairwise logistic loss; rows in a fixed order give the same pairs each time."""
    if not len(good) or not len(bad):
        return Strength(None, None, None, 0.0)
    both = np.vstack([good, bad])
    spread = both.std(axis=0)
    model = Strength(both.mean(axis=0), np.where(spread > 1e-12, spread, 1.0), None, 0.0)
    g, b = model.terms(good), model.terms(bad)
    pairs = np.arange(max(len(g), len(b)) * RIVALS)
    round_ = pairs // max(len(g), len(b))
    # each round pairs the shorter list with the longer one at another shift
    i, j = (pairs, pairs * 1 + round_ * 7919) if len(g) >= len(b) else (pairs + round_ * 7919, pairs)
    d = g[i % len(g)] - b[j % len(b)]
    w = np.zeros(d.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))
        gradient = -(d * p[:, None]).mean(axis=0) + RIDGE * w
        curvature = (d * (p * (1 - p))[:, None]).T @ d / len(d) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curvature, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    model.weights = w
    ends = np.concatenate([g @ w, b @ w])
    model.cuts = np.linspace(ends.min(), ends.max(), BINS)
    model.threshold = best_cut(model.cuts, *(np.histogram(x @ w, [-np.inf, *model.cuts, np.inf])[0] for x in (g, b)))
    return model


def best_cut(cuts: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """Of ``cuts`` the one with the best balanced accuracy, the middle one of equals; the counts are of the bins between them."""
    passed, caught = 1 - np.cumsum(good)[:-1] / good.sum(), np.cumsum(bad)[:-1] / bad.sum()
    best = np.flatnonzero(np.isclose(passed + caught, (passed + caught).max()))
    return float(cuts[best[len(best) // 2]])


def known_labels(labels: DataFrame) -> DataFrame:
    """id and quality of the documents with one label that are not held out."""
    return (
        labels.select("doc_id", "quality").filter("doc_id is not null and quality is not null").groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).filter("quality = most and quality in (0, 1)")
        .filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("id"), "quality")
    )


def training_labels(known: DataFrame, sample: int) -> DataFrame:
    """id and quality of at most ``sample`` documents of each class, those with the smallest hashes."""
    drawn = known.withColumn("drawn", F.xxhash64("id"))
    parts = [drawn.filter(F.col("quality") == q).orderBy("drawn", "id").limit(sample) for q in (0, 1)]
    return parts[0].unionByName(parts[1]).select("id", "quality")


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Strength:
    """Weights from the sample, then the threshold from the strengths of all labelled documents."""
    known = saved(known_labels(labels), "labels")
    texts = texts_of(docs)

    def texts_with(chosen: DataFrame) -> DataFrame:
        return texts.join(chosen, texts.doc_id == chosen.id).groupBy("id", "quality").agg(F.min("text").alias("text"))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b.id, "quality": b.quality, "x": [measures(t) for t in b.text]})
    chosen = F.broadcast(training_labels(known, sample))  # at most 2 x ``sample`` rows
    rows = texts_with(chosen).mapInPandas(measure, "id long, quality int, x array<double>").toPandas().sort_values("id")
    x = {q: np.array(rows.x[rows.quality == q].tolist()) for q in (0, 1)}
    model = fit(x[1], x[0])
    if model.weights is None:
        return model

    def bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"quality": b.quality, "bin": np.searchsorted(model.cuts, model.strengths(b.text.tolist()), side="right")})
    counted = texts_with(small(known)).mapInPandas(bins, "quality int, bin int").groupBy("quality", "bin").count().collect()  # 2 x BINS rows
    histogram = np.zeros((2, BINS + 1))
    for r in counted:
        histogram[r["quality"], r["bin"]] = r["count"]
    model.threshold = best_cut(model.cuts, histogram[1], histogram[0])
    return model


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    model = learn(docs, labels, sample)

    def rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b.doc_id.astype("Int64"), "score": model.score(model.strengths(b.text.tolist()))})

    found = texts_of(docs).mapInPandas(rate, "doc_id long, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def kept_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that are predicted good, with all their columns."""
    model = learn(docs, labels, sample)

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(model.strengths([t or "" for t in texts])) >= CUT)
    return docs.filter(good("text"))
