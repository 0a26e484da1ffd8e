"""Document quality learned from positives and unlabelled text, by the non-negative unbiased risk."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


# Bounds of the sample that the model is fitted to: rows with the smallest hashes of their ids.
POSITIVES = 8_000
UNLABELLED = 12_000
STEPS = 600
SEED = 7

# Sixteen classes of bytes; the features count which class follows which.
_GROUPS = (b" ", b"\n", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".", b",", b"!?", b"#*%&$@~^", b"|<>{}[]\\`", b"\"'", b":;", b"-_=+/", b"()\t\r")
_CLASS = np.full(256, 15, np.int64)
for _k, _group in enumerate(_GROUPS):
    _CLASS[list(_group)] = _k
_CLASS[128:] = 14
FEATURES = 256 + 6


def features(text: str | None) -> np.ndarray:
    """Of the whole text: shares of class pairs, repetition of words and lines, length; all zero for an empty one."""
    row = np.zeros(FEATURES, np.float32)
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return row
    kinds = _CLASS[np.frombuffer(raw, np.uint8)]
    row[:256] = np.sqrt(np.bincount(kinds[:-1] * 16 + kinds[1:], minlength=256) / len(raw))
    lines = raw.split(b"\n")
    row[256:] = (
        len(set(words)) / len(words),
        sum(a == b for a, b in zip(words, words[1:])) / len(words),
        len(set(lines)) / len(lines),
        math.log1p(len(words)) / 10,
        min(len(raw) / len(words) / 10, 3),
        len(set(words)) / math.sqrt(len(words)) / 10,
    )
    return row


@dataclass(frozen=True)
class QualityModel:
    """Logistic over standardised features; `prior` is the class prior it was fitted with."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, texts: pd.Series) -> np.ndarray:
        out = np.empty(len(texts))
        for low in range(0, len(texts), 1024):
            rows = np.stack([features(t) for t in texts.iloc[low : low + 1024]])
            out[low : low + 1024] = _sigmoid(self._standard(rows) @ self.weights + self.bias)
        return out

    def _standard(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -4, 4)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(z, np.float64)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS) -> QualityModel:
    """Minimise prior R_p(+) + max(0, R_u(-) - prior R_p(-)) with the logistic loss.

    The scores are shifted so that the prior's share of the unlabelled rows is called positive, or more where a trusted
    positive would not be. In a step in which the estimated risk of negatives is below zero, which no true risk can be, the step goes up
    that term instead, so that the model doesn't learn the unlabelled rows by heart.
    """
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(0), both.std(0) + 1e-2
    model = QualityModel(mean, scale, np.zeros(both.shape[1]), 0.0, prior)
    p, u = (np.c_[model._standard(x), np.ones(len(x))].astype(np.float64) for x in (positive, unlabelled))
    rng = np.random.default_rng(SEED)
    w, m, v = np.zeros(p.shape[1]), 0.0, 0.0
    w[-1] = math.log(prior / (1 - prior))
    for step in range(1, steps + 1):
        a, b = (x[rng.integers(0, len(x), min(len(x), 2048))] for x in (p, u))
        za, zb = a @ w, b @ w
        sa, sb = _sigmoid(za), _sigmoid(zb)
        # Losses of calling a row positive or negative are log(1 + exp(-z)) and log(1 + exp(z)).
        negative = np.logaddexp(0, zb).mean() - prior * np.logaddexp(0, za).mean()
        up = b.T @ sb / len(b) - prior * (a.T @ sa) / len(a)
        grad = prior * (a.T @ (sa - 1)) / len(a) + up if negative >= 0 else -up
        grad = grad + 1e-3 * np.r_[w[:-1], 0]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - 0.02 * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    # The prior says how much of the unlabelled text is positive; trusted positives stay on that side.
    middle = min(np.quantile(u @ w, 1 - prior), np.quantile(p @ w, 0.001))
    return QualityModel(mean, scale, w[:-1], float(w[-1] - middle), prior)


def held_out(id_column: str = "doc_id") -> Column:
    """The fold that no label is learned from; a row without an id isn't in it."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % 3 == 1


def class_prior(positives: int, negatives: int) -> float:
    """The share of positives that the trusted labels show, within 0.05 and 0.95."""
    return min(0.95, max(0.05, (positives + 1) / (positives + negatives + 2)))


def train(documents: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled_rows: int = UNLABELLED) -> QualityModel | None:
    """Fit to labels outside the held-out fold; None if there is no positive.

    Labels of one id that contradict each other and labels that are null don't count. Trusted positives are
    documents with quality 1, unlabelled text is that of documents without a label, or of all learned ones, their labels ignored, if every one has
    a label. Documents with quality 0 go into the
    class prior only. Both samples are bounded, by `positives` and `unlabelled_rows`; the prior counts all labels.
    """
    marks = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .where("quality = most")
        .select("doc_id", "quality")
    )
    learned = ~held_out()
    counted = {r["quality"]: r["n"] for r in marks.where(learned).groupBy("quality").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("doc_id", "text_hash")
    ids = documents.where(learned & F.col("doc_id").isNotNull()).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    good = ids.join(marks.where("quality = 1"), "doc_id", "left_semi")
    rest = ids.join(labels, "doc_id", "left_anti")
    vectors = F.pandas_udf(lambda texts: texts.map(lambda t: features(t).tobytes()), "binary")

    def matrix(rows: DataFrame, most: int) -> np.ndarray:
        sample = _smallest(rows, order, most=most).select("text", order.alias("o")).orderBy("o").limit(most)
        # Executors answer in any order; the fit takes the rows in that of their hashes.
        held = sample.select("o", vectors("text").alias("row")).toArrow().to_pylist()
        ordered = sorted((r["o"], r["row"]) for r in held)
        return np.frombuffer(b"".join(row for _, row in ordered), np.float32).reshape(-1, FEATURES)

    positive, unlabelled = matrix(good, positives), matrix(rest, unlabelled_rows)
    if not len(positive):
        return None
    if not len(unlabelled):
        unlabelled = matrix(ids, unlabelled_rows)
    return fit(positive, unlabelled, prior=class_prior(counted.get(1, 0), counted.get(0, 0)))


def _smallest(rows: DataFrame, order: Column, most: int) -> DataFrame:
    """Rows whose hash is below a bound that leaves `most` rows or a few more, so that only these carry their texts on."""
    bound = rows.select(order.alias("o")).orderBy("o").offset(most).limit(1).first()
    return rows if bound is None else rows.where(order < F.lit(bound["o"]))


def score(documents: DataFrame, model: QualityModel | None, text_column: str = "text") -> Column:
    """The probability of quality 1 for each text, null and empty ones included; 0.5 if there is no model."""
    if model is None:
        return F.lit(0.5)
    return F.pandas_udf(lambda texts: pd.Series(model.scores(texts)), "double")(F.col(text_column))


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted` per row of `documents`.

    Null ids stay null, null and empty texts get the score of a text without features, repeated rows come out
    repeated, other columns are ignored, an empty table gives no rows. Without labels every score is 0.5.
    """
    model = train(documents, labels)
    scored = documents.select("doc_id", held_out().alias("held_out"), score(documents, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `documents` that the classifier doesn't reject, with all their columns.

    Null and empty texts have the score of a text without features and go or stay alike; null ids are judged by their text, repeated rows go or
    stay together, and without labels, or with an empty table, nothing is rejected.
    """
    return documents.where(score(documents, train(documents, labels)) >= 0.5)
