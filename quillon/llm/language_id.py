"""Language identification by sparse multinomial logistic regression.

A text is its TF-IDF vector over hashed character 1- to 3-grams (of its
letters, lower-cased, with one space for any run of others).  The weights are
trained by FTRL-proximal, whose per-coordinate steps and elastic-net penalty
keep most of them at exactly zero, on a bounded sample of labelled rows; a
temperature fitted on rows left out of that calibrates the probabilities.
Document frequencies are counted over all labelled rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Model(NamedTuple):
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


@cache
def alphabet() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.array([chr(point).isalpha() for point in range(sys.maxunicode + 1)])


def letters(text: str | None) -> np.ndarray:
    """Code points of the letters, lower-cased, and one space between runs of them."""
    lowered = (text or "").lower()
    points = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(points):
        return points
    is_letter = alphabet()[points]
    keep = is_letter | np.concatenate([[False], is_letter[:-1]])
    return np.where(is_letter, points, np.uint32(32))[keep]


def features(text: str | None, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature ids and 1 + log of their counts; of the whole text."""
    points = letters(text)
    if not len(points) or (points == 32).all():
        return np.zeros(0, np.int64), np.zeros(0)
    padded = np.concatenate([[32], points, [32]]).astype(np.uint64)
    with np.errstate(over="ignore"):
        h, found = np.zeros(len(padded), np.uint64), []
        for n in (1, 2, 3):
            h = h[: len(padded) - n + 1] * np.uint64(0x100000001B3) + padded[n - 1 :] + np.uint64(n)
            found.append(((h * _MIX) >> np.uint64(40)) % np.uint64(buckets))
    counts = np.bincount(np.concatenate(found).astype(np.int64), minlength=buckets)
    ids = np.flatnonzero(counts)
    return ids, 1 + np.log(counts[ids])


def document_frequencies(rows: DataFrame, buckets: int) -> tuple[int, np.ndarray]:
    """Number of ``rows`` (text) and, for each feature, of those that have it."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, held = 0, np.zeros(buckets, dtype=np.int64)
        for pdf in batches:
            for text in pdf["text"]:
                held[features(text, buckets)[0]] += 1
                total += 1
        ids = np.flatnonzero(held)
        yield pd.DataFrame({"feature": np.append(ids, -1), "n": np.append(held[ids], total)})

    got = rows.select("text").mapInPandas(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    frequencies = np.zeros(buckets)
    real = got[got["feature"] >= 0]
    frequencies[real["feature"].to_numpy()] = real["n"].to_numpy()
    return int(got.loc[got["feature"] < 0, "n"].sum()), frequencies


def probabilities(logits: np.ndarray, temperature: float = 1.0) -> np.ndarray:
    z = logits / temperature
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, buckets: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1, epochs: int = 2, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Weights (buckets x classes) and bias by follow-the-regularised-leader with penalties ``l1`` and ``l2``."""
    z, n = np.zeros((buckets + 1, classes)), np.zeros((buckets + 1, classes))

    def weights(at: np.ndarray) -> np.ndarray:
        lean = np.where(at == buckets, 0.0, l1)[:, None]
        return np.where(np.abs(z[at]) <= lean, 0.0, -(z[at] - np.sign(z[at]) * lean) / ((beta + np.sqrt(n[at])) / alpha + l2))

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            ids, x = rows[k]
            at, x = np.append(ids, buckets), np.append(x, 1.0)
            w = weights(at)
            g = probabilities(x @ w)
            g[y[k]] -= 1
            step = x[:, None] * g
            sigma = (np.sqrt(n[at] + step**2) - np.sqrt(n[at])) / alpha
            z[at] += step - sigma * w
            n[at] += step**2
    w = weights(np.arange(buckets + 1))
    return w[:-1], w[-1]


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search over its logarithm."""
    def loss(t: float) -> float:
        return -np.log(np.maximum(probabilities(logits, np.exp(t))[np.arange(len(y)), y], 1e-12)).mean()

    low, high, golden = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def vector(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ids, tf = features(text, len(idf))
    x = tf * idf[ids]
    size = np.sqrt((x**2).sum())
    return ids, x / size if size else x


def train(labelled: DataFrame, rows_per_lang: int = 1200, buckets: int = BUCKETS) -> Model | None:
    """A model from ``labelled`` (key, text, lang); None without a labelled text that has a letter.

    Per language about ``rows_per_lang`` rows, drawn by a hash of ``key``, are
    fitted (a fifth of them for the temperature); document frequencies are of
    all rows.  The drawn rows' sparse vectors come to the driver.
    """
    rows = labelled.where("lang is not null")
    total, frequencies = document_frequencies(rows, buckets)
    idf = np.log((1 + total) / (1 + frequencies)) + 1
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    span = 1 << 20
    shares = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(int(span * min(1.0, rows_per_lang / n))))])
    drawn = rows.where(F.pmod(F.xxhash64(F.lit(21), "key"), F.lit(span)) < shares[F.col("lang")])

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [vector(text, idf) for text in pdf["text"]]
            yield pd.DataFrame({"at": pdf["at"], "lang": pdf["lang"], "ids": [g[0].astype(np.int32) for g in got], "x": [g[1].astype(np.float32) for g in got]})

    sample = drawn.select(F.xxhash64(F.lit(22), "key").alias("at"), "text", "lang").mapInPandas(measure, "at long, lang string, ids array<int>, x array<float>").toPandas()
    sample = sample[sample["ids"].map(len) > 0].sort_values(["at", "lang"])
    if not len(sample):
        return None
    langs = sorted(sample["lang"].unique())
    y = sample["lang"].map({lang: k for k, lang in enumerate(langs)}).to_numpy()
    held = [(np.asarray(i, dtype=np.int64), np.asarray(x, dtype=np.float64)) for i, x in zip(sample["ids"], sample["x"], strict=True)]
    aside = (sample["at"].to_numpy() % 5) == 0
    if aside.all() or not aside.any():
        aside = np.zeros(len(held), dtype=bool)
    fit, check = np.flatnonzero(~aside), np.flatnonzero(aside)
    weights, bias = ftrl([held[k] for k in fit], y[fit], len(langs), buckets)
    logits = np.array([held[k][1] @ weights[held[k][0]] + bias for k in check]) if len(check) else np.zeros((0, len(langs)))
    return Model(langs, idf.astype(np.float32), weights.astype(np.float32), bias, fit_temperature(logits, y[check]) if len(check) else 1.0)


def predict(model: Model | None, text: Column) -> Column:
    """lang and score of a text; ``und`` and 0 for null texts, texts without a letter and without a model."""

    @F.pandas_udf("struct<lang:string,score:double>")
    def judge(texts: pd.Series) -> pd.DataFrame:
        langs, scores = [], []
        for text in texts:
            ids, x = vector(text, model.idf) if model else ((), ())
            if not len(ids):
                langs.append("und")
                scores.append(0.0)
                continue
            p = probabilities(x @ model.weights[ids] + model.bias, model.temperature)
            best = int(p.argmax())
            langs.append(model.langs[best])
            scores.append(float(p[best]))
        return pd.DataFrame({"lang": langs, "score": scores})

    return judge(text)


def identify(docs: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of ``docs`` (doc_id, text, lang); learned from rows that aren't held out.

    A row is held out if crc32 of its id as text falls into ``fold``; rows
    with null ids are not, and rows with null languages teach nothing.  Texts
    of any length are read whole; rows that repeat an id are judged one by one;
    an empty table gives none; other columns are left out.
    """
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))
    model = train(docs.where(~out).select(F.col("doc_id").alias("key"), "text", "lang"))
    judged = docs.select("doc_id", out.alias("held_out"), predict(model, F.col("text")).alias("judged"))
    return judged.select("doc_id", "held_out", F.col("judged.lang").alias("lang_pred"), F.col("judged.score").alias("score"))
