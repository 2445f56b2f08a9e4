"""Quality classifier from positives and unlabelled text.

A linear model over step functions of text measurements is fitted by minimising the
non-negative unbiased risk: trusted positives (label 1) and unlabelled documents are
weighed with the class prior, and the part of the risk that estimates the negatives may
not become negative. The prior is estimated from the positives and the unlabelled alone:
a first model separates the two, and over its best scores the share of unlabelled
documents relative to that of positives tends to the prior.

Fitting takes at most ``N_POSITIVE`` and ``N_UNLABELLED`` documents, those with the
smallest hash of their id, and only documents whose id belongs to the learning fold.
Copies among them count a few times only. Every document is scored.

Defined cases: a null or empty text is scored by its measurements, which are zeros; a
null id counts as empty text in the fold; labels that contradict each other count as no
trusted positive; without positives to learn from, every document scores 0.5; repeated
rows get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from helixspan.llm.texts import WORD, boxed, in_box, per_text, pick, smallest, unboxed

N_POSITIVE, N_UNLABELLED = 3000, 6000
#: Cuts per measurement, steps, step size, and shrinkage of the fit.
CUTS, STEPS, RATE, SHRINK = 12, 400, 0.05, 2e-4
#: Sampled documents with about the same measurements that count.
ALIKE = 5
#: Best share of scores looked at for the prior.
LEAST_MASS = 0.05

WORDS = re.compile(WORD)
MARKS = np.frombuffer(b"#*$%&|<>!", np.uint8)
DIGITS = np.arange(ord("0"), ord("9") + 1)
CAPITALS = np.arange(ord("A"), ord("Z") + 1)
FEATURES = 14


def fold(doc_id: Column, parts: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts


def measurements(text: str | None) -> list[float]:
    text = text or ""
    raw = text.encode()
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = WORDS.findall(text)
    n, size = max(1, len(words)), max(1, len(raw))
    lines = [line for line in text.split("\n") if line]
    counts = Counter(words)
    pairs = set(zip(words, words[1:], strict=False))
    return [
        float(bytes_[MARKS].sum()) / n,
        sum(map(str.isupper, words)) / n,
        counts["|"] / n,
        sum(map(eq, words, words[1:])) / n,
        1 - len(pairs) / max(1, len(words) - 1) if len(words) > 1 else 0.0,
        1 - len(counts) / n,
        sum(map(len, words)) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        float(bytes_[DIGITS].sum()) / n,
        max(counts.values(), default=0) / n if len(words) >= 20 else 0.0,
        sum(map(str.isalpha, words)) / n,
        len(zlib.compress(raw, 1)) / size if size >= 200 else 0.5,
        float(bytes_[CAPITALS].sum()) / size,
        min(len(words), 20) / 20,
    ]


def steps_of(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Indicators x > cut, and a constant."""
    indicators = (x[:, :, None] > cuts[None, :, :]).reshape(len(x), -1).astype(np.float64)
    return np.hstack([np.ones((len(x), 1)), indicators])


def descend(gradient, size: int, steps: int = STEPS, rate: float = RATE) -> np.ndarray:
    """Adam on a gradient function of the weights."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled.

    A model of positives against unlabelled is fitted to one half and its scores of the
    other half are cut at every level that keeps ``LEAST_MASS`` of the positives.
    """
    a, b = positive[::2], unlabelled[::2]

    def gradient(w):
        return (
            -(a.T @ (1 - sigmoid(a @ w))) / len(a) + (b.T @ sigmoid(b @ w)) / len(b) + SHRINK * w
        )

    w = descend(gradient, a.shape[1])
    p, u = np.sort(positive[1::2] @ w), np.sort(unlabelled[1::2] @ w)
    levels = p[: max(1, int(len(p) * (1 - LEAST_MASS)))]
    share_p = 1 - np.searchsorted(p, levels) / len(p)
    share_u = 1 - np.searchsorted(u, levels) / len(u)
    # An upper confidence bound keeps small samples from choosing a lucky level.
    slack = (np.sqrt(np.log(20) / len(u)) + np.sqrt(np.log(20) / len(p))) / 2
    best = np.argmin((share_u + slack) / share_p)
    return float(np.clip(share_u[best] / share_p[best], 0.05, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(cuts, weights, prior) from two tables of measurements."""
    both = np.vstack([positive, unlabelled])
    levels = np.concatenate([np.linspace(0.02, 0.98, CUTS - 3), [0.985, 0.99, 0.995]])
    cuts = np.quantile(both, levels, axis=0).T
    p, u = steps_of(positive, cuts), steps_of(unlabelled, cuts)
    prior = estimate_prior(p, u)

    def gradient(w):
        sp, su = sigmoid(p @ w), sigmoid(u @ w)
        # Logistic loss: as positive log(1 + exp(-z)), as negative log(1 + exp(z)).
        negative = np.logaddexp(0, u @ w).mean() - prior * np.logaddexp(0, p @ w).mean()
        as_positive = -prior * (p.T @ (1 - sp)) / len(p)
        as_negative = (u.T @ su) / len(u) - prior * (p.T @ sp) / len(p)
        if negative < 0:
            return -as_negative  # step back instead of fitting noise below zero
        return as_positive + as_negative + SHRINK * w

    return cuts, descend(gradient, p.shape[1]), prior


def train(docs: DataFrame, labels: DataFrame, held: tuple[int, int] | None = (3, 1)):
    """Fit on documents outside the fold ``held`` = (parts, remainder); None: on all.

    At most ``N_POSITIVE`` + ``N_UNLABELLED`` rows of measurements reach the driver.
    """
    outside = F.lit(True) if held is None else fold(F.col("doc_id"), held[0]) != held[1]
    texts = pick(docs, "doc_id", "text").where(outside).where("doc_id IS NOT NULL")
    marked = (
        pick(labels, "doc_id", "quality").where(outside).groupBy("doc_id")
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    )
    order = F.xxhash64(F.col("doc_id"), F.lit("quality"))
    trusted = marked.where("low = 1 AND high = 1").select("doc_id", order.alias("o"))
    trusted = smallest(trusted, "o", N_POSITIVE, trusted.count())
    ids = texts.select("doc_id").distinct()
    others = ids.join(marked.select("doc_id"), "doc_id", "left_anti").select("doc_id", order.alias("o"))
    others = smallest(others, "o", N_UNLABELLED, ids.count())
    chosen = trusted.withColumn("p", F.lit(1)).unionByName(others.withColumn("p", F.lit(0)))
    measured = per_text(lambda: measure_all, "x array<double>")
    rows = (
        texts.join(F.broadcast(chosen), "doc_id")  # at most N_POSITIVE + N_UNLABELLED ids
        .orderBy("o", F.xxhash64("text"))
        .limit(2 * (N_POSITIVE + N_UNLABELLED))
        .select("p", "o", measured("text").alias("m"))
        .select("p", "o", "m.x")
        .collect()
    )
    rows.sort(key=lambda r: (r["o"], r["x"]))
    x = np.array([r["x"] for r in rows], dtype=np.float64).reshape(len(rows), FEATURES)
    p = np.array([r["p"] for r in rows], dtype=bool)
    positive, unlabelled = without_copies(x[p]), without_copies(x[~p])
    if len(positive) < 20 or len(unlabelled) < 20:
        return None
    return fit(positive, unlabelled)


def without_copies(x: np.ndarray) -> np.ndarray:
    """At most ``ALIKE`` rows with equal rounded measurements, the first ones, in order.

    A large group of copies that happens to be unlabelled says nothing about its quality.
    """
    _, cell = np.unique(np.round(x, 2), axis=0, return_inverse=True)
    seen: dict[int, int] = {}
    keep = []
    for i, c in enumerate(cell.ravel().tolist()):
        seen[c] = seen.get(c, 0) + 1
        if seen[c] <= ALIKE:
            keep.append(i)
    return x[keep]


def measure_all(texts: list[str | None]) -> list[tuple]:
    return [(measurements(text),) for text in texts]


def scorer(model):
    """Column function text -> score; the model is a few hundred numbers."""

    def make():
        def work(texts: list[str | None]) -> list[tuple]:
            if model is None:
                return [(0.5,)] * len(texts)
            cuts, weights, _ = model
            x = np.array([measurements(t) for t in texts], dtype=np.float64).reshape(-1, FEATURES)
            return [(float(s),) for s in sigmoid(steps_of(x, cuts) @ weights)]

        return work

    run = per_text(make, "score double")
    return lambda text: run(text)["score"]


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    score = scorer(train(docs, labels))
    return (
        pick(docs, "doc_id", "text")
        .select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), score(F.col("text")).alias("score"))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score at least 0.5, with their columns."""
    names = docs.columns
    score = scorer(train(docs, labels, held=None))
    scored = boxed(docs).select("row", score(in_box(names, "text")).alias("score"))
    return unboxed(scored.where("score >= 0.5"), names)
