"""Quality by Bradley-Terry pairwise ranking.

A document of label 1 is preferred to one of label 0.  The probability that document i beats
document j is the logistic function of ``w . (x_i - x_j)``; ``w`` minimises the logistic loss
over sampled preference pairs.  The document's own score is ``w . x``, and a quantile of the
training scores is the threshold between accepted and rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_crc
from tidemark.session import ship_package

# Parameters of the fit, all bounded whatever the size of the tables.
SAMPLE = 20_000  # labelled documents of each class, expected, chosen by a hash of the id
PAIRS = 200_000  # preference pairs drawn from them
RIDGE = 1e-3
PART = 40  # words of a part, for the features of the worst part
PRIOR = 10  # plain words added to every count of words, so that short texts are not judged by chance
CUT = 0.3  # score at the threshold

_KIND = np.full(256, 4, dtype=np.uint8)  # 4: symbols
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[97:123] = 1
_KIND[128:] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[[ord(c) for c in ".,;:'\"-?()"]] = 5

FEATURES = (
    "log_words",
    "mean_length",
    "upper",
    "digit",
    "symbol",
    "common_mark",
    "distinct",
    "repeat",
    "top_share",
    "odd_ends",
    "no_letter",
    "line_repeat",
    "words_a_sentence",
    "worst_repeat",
    "worst_symbol",
    "worst_upper",
    "worst_distinct",
)


def features(text: str | None) -> np.ndarray:
    """Shares and means over the whole text, and the worst value of any part of 40 words.  A
    text without words repeats nothing and has no marks."""
    out = np.zeros(len(FEATURES))
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        out[[FEATURES.index("distinct"), FEATURES.index("worst_distinct")]] = 1.0
        return out
    kinds = _KIND[np.frombuffer(raw, dtype=np.uint8)]
    counts = np.bincount(kinds, minlength=6)
    solid = len(raw) - counts[0]
    letters = max(1, counts[1] + counts[2])
    ids: dict[bytes, int] = {}
    seen = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=n)
    often = np.bincount(seen)
    same = seen[1:] == seen[:-1]
    ends = _KIND[np.fromiter((w[-1] for w in words), dtype=np.uint8, count=n)]
    lines = [x for x in raw.split(b"\n") if x.strip()]
    sentences = max(1, raw.count(b"."))
    # where each part of words begins and ends among the bytes
    starts = np.nonzero((kinds[1:] != 0) & (kinds[:-1] == 0))[0] + 1
    if kinds[0] != 0:
        starts = np.concatenate(([0], starts))
    at = starts[::PART]
    size = np.maximum(1, np.add.reduceat(kinds != 0, at))
    symbols = np.add.reduceat(kinds == 4, at) / size
    upper = np.add.reduceat(kinds == 2, at) / np.maximum(1, np.add.reduceat((kinds == 1) | (kinds == 2), at))
    first = np.arange(0, n, PART)
    width = np.minimum(PART, n - first)
    again = np.add.reduceat(np.concatenate(([False], same)).astype(np.int64), first) / (width + PRIOR)
    part = np.arange(n) // PART
    pairs = np.unique(part * len(often) + seen)
    fresh = (np.bincount(pairs // len(often), minlength=len(first)) + PRIOR) / (width + PRIOR)
    whole = width >= min(n, PART // 2)  # a short rest at the end says little
    out[:] = (
        np.log1p(n),
        solid / n,
        counts[2] / letters,
        counts[3] / solid,
        counts[4] / solid,
        counts[5] / solid,
        (len(often) + PRIOR) / (n + PRIOR),
        same.sum() / (n + PRIOR),
        (often.max() - 1) / (n + PRIOR),
        (ends == 4).sum() / (n + PRIOR),
        1 - letters / solid if letters < solid else 0.0,
        1 - (len(set(lines)) + PRIOR) / (len(lines) + PRIOR),
        np.log1p(n / sentences),
        again[whole].max(initial=0),
        symbols[whole].max(initial=0),
        upper[whole].max(initial=0),
        fresh[whole].min(initial=1),
    )
    return out


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        """Bradley-Terry strength of each row of features."""
        return (x - self.mean) / self.scale @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1: the chance to beat a document at the threshold, moved so that the
        threshold itself scores ``CUT``."""
        z = self.strength(x) - self.threshold + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(x: np.ndarray, label: np.ndarray, seed: int = 7) -> QualityModel:
    """Newton steps on the mean logistic loss of feature differences, with a small ridge."""
    if not len(x):
        return QualityModel(np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros(x.shape[1]), -1.0)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = (x - mean) / scale
    good, bad = np.nonzero(label == 1)[0], np.nonzero(label == 0)[0]
    if not len(good) or not len(bad):
        # nothing to compare: every document scores alike and is kept
        return QualityModel(mean, scale, np.zeros(x.shape[1]), -1.0)
    rng = np.random.default_rng(seed)
    d = z[rng.choice(good, PAIRS)] - z[rng.choice(bad, PAIRS)]
    w = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        return np.logaddexp(0, -d @ w).mean() + RIDGE / 2 * w @ w

    now = loss(w)
    for _ in range(50):
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))
        gradient = -(d * p[:, None]).mean(axis=0) + RIDGE * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / len(d) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        t = 1.0
        while t > 1e-6 and loss(w - t * step) > now:
            t /= 2
        w, before, now = w - t * step, now, loss(w - t * step)
        if before - now < 1e-9:
            break
    return QualityModel(mean, scale, w, _threshold(z @ w, label))


def _threshold(strength: np.ndarray, label: np.ndarray) -> float:
    """The quantile of the training scores with the fewest mean errors of both classes, half
    way to the next score; among equal quantiles, the middle one."""
    order = np.argsort(strength, kind="stable")
    level, good = strength[order], label[order] == 1
    # cutting below position k rejects the k lowest scores
    lost = np.concatenate(([0], np.cumsum(good))) / good.sum()
    passed = 1 - np.concatenate(([0], np.cumsum(~good))) / (~good).sum()
    cuts = np.concatenate(([level[0] - 1], (level[1:] + level[:-1]) / 2, [level[-1] + 1]))
    possible = np.concatenate(([True], level[1:] > level[:-1], [True]))
    error = np.where(possible, lost + passed, np.inf)
    best = np.nonzero(error <= error.min() + 1e-12)[0]
    return float(cuts[best[len(best) // 2]])


def _rows(texts: pd.Series) -> np.ndarray:
    return np.stack([features(t) for t in texts]) if len(texts) else np.zeros((0, len(FEATURES)))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE
) -> QualityModel:
    """A model from labelled documents outside the held-out fifth (crc32 of the id modulo 5).

    At most about ``sample`` documents of each class are used, chosen by a hash of the id, so
    that what reaches the driver is bounded.  Labels other than 0 and 1, null ids and ids with
    both labels are left out.
    """
    ship_package(docs.sparkSession)
    known = (
        labels.select(F.col(id_col).alias("__id"), F.col("quality").cast("int").alias("__label"))
        .filter(F.col("__id").isNotNull() & F.col("__label").isin(0, 1) & (F.pmod(id_crc("__id"), F.lit(5)) != 0))
        .groupBy("__id")
        .agg(F.min("__label").alias("__label"), F.max("__label").alias("__most"))
        .filter(F.col("__label") == F.col("__most"))
        .drop("__most")
    )
    sizes = {r["__label"]: r["n"] for r in known.groupBy("__label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.when(F.col("__label") == 1, F.lit(min(1.0, sample / max(1, sizes.get(1, 0))))).otherwise(
        F.lit(min(1.0, sample / max(1, sizes.get(0, 0))))
    )
    place = F.pmod(F.xxhash64("__id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    # bounded by 2 * sample rows of two numbers
    chosen = known.filter(place < share)

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t).tolist() for t in texts])

    found = (
        docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
        .join(F.broadcast(chosen), "__id")
        .select("__id", "__label", measured("__text").alias("__x"))
        .toPandas()
        .sort_values(["__id"], kind="stable")
    )
    x = np.array(found["__x"].tolist(), dtype=float).reshape(len(found), len(FEATURES))
    return fit(x, found["__label"].to_numpy())


def scores(text: Column, model: QualityModel) -> Column:
    """The score of each whole text, empty and null ones included."""

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series(model.score(_rows(t)))

    return scored(text)


def classify(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per document.

    A null text is scored as an empty one.  A null id counts as not held out.  Repeated rows
    are scored each; an empty table gives no rows; other columns are ignored.  Without labels of
    both kinds every document scores the same and is accepted.
    """
    ship_package(docs.sparkSession)
    return (
        docs.select(F.col(id_col).alias("doc_id"), scores(F.col(text_col), model).alias("score"))
        .select(
            "doc_id",
            F.coalesce(F.pmod(id_crc("doc_id"), F.lit(5)) == 0, F.lit(False)).alias("held_out"),
            "score",
            F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted"),
        )
    )


def accepted(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    ship_package(docs.sparkSession)
    return docs.filter(scores(F.col(text_col), model) >= CUT)
