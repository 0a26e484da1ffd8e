"""Language of texts: multinomial logistic regression on TF-IDF character n-grams, fitted by follow-the-regularised-leader."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

ORDERS = (1, 2, 3)
# Buckets that n-grams are hashed to.
BUCKETS = 1 << 16
# Texts that the weights are fitted to: so many in all, shared out evenly by language, but this many of each at least; those with the smallest hashes.
SAMPLE = 12_000
LEAST_EACH = 50
# Every so manieth of them is kept for the temperature.
CALIBRATION = 5
EPOCHS = 2
FEW_LANGS = 10_000
# Of each proximal step: rate, offset of the rate, and the elastic net's two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.5, 1.0
# Characters whose n-grams a task looks up together.
LOT = 1 << 20
UNKNOWN = "und"

_MULTIPLY = np.uint32(2654435761)


def held_out(id_column: str = "doc_id") -> Column:
    """The fold that nothing is learned from; a row without an id isn't in it."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % 4 == 2


def grams(points: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of each order at each place where one begins, by code points of lower-case text."""
    code = np.zeros(len(points), np.uint32)
    for order in range(1, max(ORDERS) + 1):
        if len(points) < order:
            return
        code = (code[: len(points) - order + 1] + points[order - 1 :] + np.uint32(order)) * _MULTIPLY
        code = code ^ (code >> np.uint32(15))
        if order in ORDERS:
            yield (code & np.uint32(BUCKETS - 1)).astype(np.int32)


def points(text: str) -> np.ndarray:
    """Code points of a text in lower case with a space at both ends, so that first and last letters show."""
    return np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)


def document_counts(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of the texts each bucket comes, and how many there are; every text counts, and sums are made in executors."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total, n = np.zeros(BUCKETS, bool), np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column("text"):
                codes = np.concatenate(list(grams(points(text.as_py()))))
                seen[codes] = True
                total += seen
                seen[codes] = False
                n += 1
        if n:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"bucket": np.append(at, -1).astype(np.int32), "n": np.append(total[at], n)})

    sums = texts.mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    buckets, n = sums["bucket"].to_numpy(), sums["n"].to_numpy()
    out = np.zeros(BUCKETS, np.int64)
    out[buckets[buckets >= 0]] = n[buckets >= 0]
    return out, int(n[buckets < 0].sum())


@dataclass(frozen=True)
class LanguageModel:
    """Weights by bucket and language, times the buckets' inverse document frequency; most are zero."""

    langs: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, texts: list[str]) -> np.ndarray:
        """Of whole texts, a row each. A term's frequency is its share of the text's n-grams, so the logit is a mean over places."""
        table = (self.weights * self.idf[:, None]).astype(np.float32)
        out = np.zeros((len(texts), len(self.langs)))
        low = 0
        while low < len(texts):
            high, size, held = low, 0, []
            while high < len(texts) and (not held or size + len(texts[high]) <= LOT):
                held.append(points(texts[high]))
                size += len(held[-1])
                high += 1
            out[low:high] = _means(held, table)
            low = high
        return out + self.bias

    def probabilities(self, texts: list[str]) -> np.ndarray:
        return softmax(self.logits(texts) / self.temperature)


def _means(held: list[np.ndarray], table: np.ndarray) -> np.ndarray:
    """The mean over all n-grams of each text of their rows of `table`; a long text is looked up in stretches."""
    out, n = np.zeros((len(held), table.shape[1])), np.zeros(len(held))
    if len(held) == 1 and len(held[0]) > LOT:
        whole = held[0]
        for low in range(0, len(whole), LOT):
            for order, codes in zip(ORDERS, grams(whole[low : low + LOT + max(ORDERS) - 1])):
                codes = codes[:LOT]
                out[0] += np.bincount(codes, minlength=BUCKETS) @ table
                n[0] += len(codes)
        return out / n[:, None]
    together = np.concatenate(held)
    begin = np.concatenate([[0], np.cumsum([len(p) for p in held])])
    for order, codes in zip(ORDERS, grams(together)):
        # N-grams that reach into the next text don't count.
        good = np.ones(len(codes), bool)
        for back in range(1, order):
            ends = begin[1:] - back
            good[ends[ends < len(codes)]] = False
        row = table[codes] * good[:, None]
        sums = np.add.reduceat(row, np.minimum(begin[:-1], len(codes) - 1), axis=0, dtype=np.float64)
        out += sums
        n += np.maximum(np.diff(begin) - order + 1, 0)
    return out / np.maximum(n, 1)[:, None]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text that have weight, and their TF-IDF."""
    codes = np.concatenate(list(grams(points(text))))
    buckets, n = np.unique(codes, return_counts=True)
    values = n / len(codes) * idf[buckets]
    return buckets[values != 0], values[values != 0]


def fit(texts: list[str], labels: np.ndarray, langs: tuple[str, ...], idf: np.ndarray) -> LanguageModel:
    """FTRL-proximal over the texts in turn, each one step for all languages; L1 leaves weights at zero until their sums exceed it.

    Values are a few thousandths, so they are scaled up for the steps and the weights back.
    """
    scale = 100.0
    rows = [vector(t, idf) for t in texts]
    z, squares = np.zeros((BUCKETS + 1, len(langs))), np.zeros((BUCKETS + 1, len(langs)))

    def proximal(at: np.ndarray) -> np.ndarray:
        some = z[at]
        over = np.maximum(np.abs(some) - np.where(at == BUCKETS, 0.0, L1)[:, None], 0)
        return -np.sign(some) * over / ((BETA + np.sqrt(squares[at])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for (buckets, values), label in zip(rows, labels):
            at, x = np.append(buckets, BUCKETS), np.append(values * scale, 1.0)
            w = proximal(at)
            p = softmax(x @ w)
            p[label] -= 1
            gradient = x[:, None] * p
            more = np.sqrt(squares[at] + gradient**2) - np.sqrt(squares[at])
            z[at] += gradient - more / ALPHA * w
            squares[at] += gradient**2
    w = proximal(np.arange(BUCKETS + 1))
    return LanguageModel(langs, idf, w[:-1] * scale, w[-1])


def calibrated(model: LanguageModel, texts: list[str], labels: np.ndarray) -> LanguageModel:
    """The model with the temperature of least loss on texts it wasn't fitted to, found by golden section in its logarithm."""
    if not len(texts):
        return model
    logits = model.logits(texts)

    def loss(t: float) -> float:
        p = softmax(logits / math.exp(t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-300)).mean())

    low, high, part = math.log(0.05), math.log(20), (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - part * (high - low), low + part * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return LanguageModel(model.langs, model.idf, model.weights, model.bias, math.exp((low + high) / 2))


def train(documents: DataFrame, text_column: str = "text", lang_column: str = "lang", id_column: str = "doc_id", sample: int = SAMPLE) -> LanguageModel | None:
    """Fit to the texts and languages outside the held-out fold; None if there are none with letters.

    Document frequencies are those of all learned texts; weights and temperature are fitted to a sample of at most `sample` texts, or
    `LEAST_EACH` of each language if that is more.
    """
    text, lang = F.col(text_column), F.col(lang_column).cast("string")
    learned = documents.where(~held_out(id_column) & lang.isNotNull() & text.rlike(r"\p{L}"))
    rows = learned.select(lang.alias("lang"), F.xxhash64(F.col(id_column).cast("string"), text).alias("o"), text.alias("text"))
    counts, n = document_counts(rows.select("text"))
    if not n:
        return None
    idf = np.where(counts > 0, np.log((n + 1) / (counts + 1)) + 1, 0)
    of_lang = rows.groupBy("lang").agg(F.count("*").alias("n"))
    langs = of_lang.count()
    each = max(LEAST_EACH, sample // langs)
    # Rows below a bound by hash that lets some more through than are wanted; only these are ranked.
    share = F.least(F.lit(1.0), F.lit(each * 1.2 + 100) / F.col("n"))
    # So few languages are broadcast; a column of more is joined by key.
    low = rows.join(F.broadcast(of_lang) if langs <= FEW_LANGS else of_lang, "lang").where(F.pmod("o", F.lit(1 << 32)) < share * (1 << 32))
    ranked = low.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("o", "text")))
    held = ranked.where(F.col("rank") <= each).select("lang", "o", "text").toArrow().to_pylist()
    # Executors answer in any order; the steps go by hash.
    held.sort(key=lambda r: (r["o"], r["lang"], r["text"]))
    names = tuple(sorted({r["lang"] for r in held}))
    number = {lang: k for k, lang in enumerate(names)}
    texts, labels = [r["text"] for r in held], np.array([number[r["lang"]] for r in held])
    fold = np.arange(len(held)) % CALIBRATION == CALIBRATION - 1
    model = fit([t for t, f in zip(texts, fold) if not f], labels[~fold], names, idf)
    return calibrated(model, [t for t, f in zip(texts, fold) if f], labels[fold])


def predict(model: LanguageModel | None, text: Column) -> Column:
    """A struct `lang`, `score`: the likeliest learned language of a whole text and its probability; `und` and 0 without letters or a model."""
    nothing = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    if model is None:
        return nothing

    def likeliest(texts: pd.Series) -> pd.DataFrame:
        p = model.probabilities([t or "" for t in texts]) if len(texts) else np.zeros((0, len(model.langs)))
        best = p.argmax(1)
        return pd.DataFrame({"lang": [model.langs[k] for k in best], "score": p[np.arange(len(p)), best]})

    found = F.pandas_udf(likeliest, "lang string, score double")(text)
    return F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), found).otherwise(nothing)


def identify(documents: DataFrame, text_column: str = "text", lang_column: str = "lang", id_column: str = "doc_id") -> DataFrame:
    """`doc_id`, `held_out`, `lang_pred`, `score` per row of `documents`, from the text alone.

    A text that is null, empty or without a letter is `und` with score 0, as is every text if nothing can be learned. Null ids stay null and are
    learned from, repeated rows count and come out each time, ties go to the language first by name, other columns are ignored, an empty
    table gives no rows. Texts are read whole at any length.
    """
    model = train(documents, text_column, lang_column, id_column)
    rows = documents.select(F.col(id_column).alias("doc_id"), held_out(id_column).alias("held_out"), predict(model, F.col(text_column)).alias("best"))
    return rows.select("doc_id", "held_out", F.col("best.lang").alias("lang_pred"), F.col("best.score").alias("score"))
