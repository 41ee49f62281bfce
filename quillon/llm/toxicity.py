"""Toxicity by compression distance.

Two dictionaries are trained by zstandard on labelled text: one on windows of
ordinary texts, one on the words of toxic texts that are more frequent there
than in ordinary texts by a likelihood-ratio test (trained on whole toxic
texts, a dictionary is almost the ordinary one, as toxic texts are mostly
ordinary).  Each window of a text is compressed with the ordinary dictionary,
and with the ordinary and the toxic one together; a window is nearer to toxic
text the more bytes the latter saves.  A logistic curve over the savings of a
text's windows, fitted on labelled rows that the dictionaries haven't seen,
calibrates the threshold.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import scratch, written

#: All ASCII but letters becomes a space.
LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))
FEATURES = list("abcdef")


class Model(NamedTuple):
    """What scores a text: the dictionaries' contents and the curve; without dictionaries every score is ``prior``."""

    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float


def plain(text: str | None) -> bytes:
    """The words of a text, lower-cased, with one space between them."""
    return b" ".join((text or "").lower().encode().translate(LETTERS).split())


def padded(text: bytes) -> set[bytes]:
    """The words of a plain text, with a space on either side."""
    return {b" " + word + b" " for word in text.split()}


def windows(text: bytes, size: int, first: int | None = None) -> list[bytes]:
    """``text`` in pieces of at most ``size`` bytes, the first of ``first``, cut at spaces where there is one."""
    text, out, start, room = b" " + text + b" ", [], 0, first or size
    while start < len(text) - 1:
        end = min(len(text) - 1, start + room)
        if end < len(text) - 1:
            gap = text.rfind(b" ", start + 1, end)
            end = gap if gap > start else end
        out.append(text[start : end + 1])
        start, room = end, size
    return out or [text]


@lru_cache(maxsize=4)
def compressor(content: bytes):
    import zstandard

    params = zstandard.ZstdCompressionParameters(strategy=zstandard.STRATEGY_GREEDY, window_log=17, hash_log=17, chain_log=16, search_log=6, min_match=6, write_content_size=False, write_checksum=False, write_dict_id=False)
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=params).compress


def savings(texts: pd.Series, ordinary: bytes, toxic: bytes, window: int, most: float = 12.0) -> np.ndarray:
    """A row of features for each text, over two divisions into windows, half a window apart.

    The largest saving that both divisions have, and either; the three largest
    together; the mean; number and share of windows that save at least 3 bytes.
    Largest savings count as ``most`` at most, so that one long word isn't more
    than a short one.
    """
    one, other = compressor(ordinary), compressor(toxic)
    out = np.zeros((len(texts), 6))
    for k, text in enumerate(texts):
        words = plain(text)
        two = [np.array([len(one(w)) - len(other(w)) for w in windows(words, window, first)]) for first in (window, window // 2)]
        saved = np.concatenate(two)
        over = (saved >= 3).sum()
        tops = [x.max() for x in two]
        out[k] = min(most, *tops), min(most, max(tops)), np.minimum(most, np.sort(saved)[-6:]).sum() / 2, saved.mean(), math.log1p(over / 2), over / len(saved)
    return out


def ratio_test(a: Column, b: Column, toxic: int, ordinary: int) -> Column:
    """Twice the log-likelihood that a word's frequency differs, for ``a`` of ``toxic`` and ``b`` of ``ordinary`` documents."""

    def part(k: Column, n: int, p: Column) -> Column:
        rest = F.lit(n) - k
        return F.when(k > 0, k * F.log(p)).otherwise(0.0) + F.when(rest > 0, rest * F.log(1 - p)).otherwise(0.0)

    both = (a + b) / F.lit(toxic + ordinary)
    return 2 * (part(a, toxic, a / F.lit(toxic)) + part(b, ordinary, b / F.lit(ordinary)) - part(a, toxic, both) - part(b, ordinary, both))


def trained(samples: list[bytes], size: int, k: int = 16, d: int = 6) -> bytes:
    """A dictionary of about ``size`` bytes that zstandard trains on ``samples``; the samples themselves where they are too few for it."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, k=k, d=d).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def learn_dictionaries(rows: DataFrame, toxic: int, ordinary: int, size: tuple[int, int], shares: tuple[float, ...], ratio: float, chance: float, window: int, drawn_windows: int) -> tuple[bytes, list[bytes]]:
    """The ordinary dictionary, and a toxic one for each of ``shares``, from ``rows`` (text, toxic), of which there are so many of either kind.

    A word marks toxic text if at least that share of toxic texts has it,
    ``ratio`` times that of ordinary ones, and the likelihood ratio is beyond
    ``chance`` over all words that were counted.  A toxic dictionary's samples
    are these words, each as often as there are toxic texts that have it.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for start in range(0, len(pdf), 200):
                part = pdf.iloc[start : start + 200]
                seen = Counter(), Counter()
                for text, label in zip(part["text"], part["toxic"], strict=True):
                    seen[label].update(padded(plain(text)))
                keys = list(seen[1].keys())
                yield pd.DataFrame({"word": keys, "a": [seen[1][k] for k in keys], "b": [seen[0][k] for k in keys]})
                keys = list(seen[0].keys() - seen[1].keys())
                yield pd.DataFrame({"word": keys, "a": np.zeros(len(keys), np.int64), "b": [seen[0][k] for k in keys]})

    counts = rows.mapInPandas(count, "word binary, a long, b long").groupBy("word").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    counts = written(counts.where("a > 0"), "words")
    tested = counts.count()
    power = ratio_test(F.col("a"), F.col("b"), toxic, ordinary)
    more = (F.col("a") + 0.5) / (toxic + 1) >= ratio * (F.col("b") + 0.5) / (ordinary + 1)
    strong = counts.where(more & (power >= 2 * math.log(max(tested, 1) / chance)) & (F.col("a") >= min(shares) * toxic)).orderBy("word").collect()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for text in pdf["text"]:
                yield pd.DataFrame({"part": windows(plain(text), window)})

    parts = rows.where("toxic = 0").select("text").mapInPandas(cut, "part binary")
    total = rows.where("toxic = 0").agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    span = 1 << 20
    at = F.xxhash64(F.lit(13), "part")
    drawn = parts.where(F.pmod(at, F.lit(span)) < int(span * min(1.0, drawn_windows * window / max(total, 1)))).select(at.alias("at"), "part").collect()
    ground = trained([bytes(r["part"]) for r in sorted(drawn, key=lambda r: (r["at"], bytes(r["part"])))], size[0]) or b" " * 64
    out = []
    for share in shares:
        samples = [bytes(r["word"]) for r in strong if r["a"] >= share * toxic for _ in range(r["a"])]
        np.random.default_rng(5).shuffle(samples)
        out.append(trained([b"".join(samples[k : k + 4]) for k in range(0, len(samples), 4)], size[1]))
    return ground, out


def fit_curve(x: np.ndarray, y: np.ndarray, prior: float, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean and scale of the features, and weights (the last is the constant) by Newton's method; the constant is moved to ``prior``."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    here = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w[-1] += math.log(prior / (1 - prior)) - math.log(here / (1 - here))
    return mean, scale, w


def log_loss(x: np.ndarray, y: np.ndarray, prior: float) -> float:
    """Of a curve fitted on every other row, over the rest."""
    mean, scale, w = fit_curve(x[::2], y[::2], float(np.clip(y[::2].mean(), 1e-3, 1 - 1e-3)))
    p = 1 / (1 + np.exp(-np.clip((x[1::2] - mean) / scale @ w[:-1] + w[-1], -30, 30)))
    return float(-np.log(np.maximum(np.where(y[1::2] == 1, p, 1 - p), 1e-12)).mean()) if len(y) > 1 else 0.0


def train(
    docs: DataFrame, labels: DataFrame, toxic_rows: int = 2000, ordinary_rows: int = 6000, ordinary_bytes: int = 1 << 14, toxic_bytes: int = 1 << 12, window: int = 64, shares: tuple[float, ...] = (0.003, 0.02),
    ratio: float = 12.0, chance: float = 0.01, drawn_windows: int = 1 << 16,
) -> Model:
    """A model from the texts of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic: 0 or 1; null: no part) has.

    About ``toxic_rows`` toxic and ``ordinary_rows`` other labels are drawn by
    a hash of their ids; equal texts count once; half of the texts make the
    dictionaries (the ordinary one from about ``drawn_windows`` windows), half
    the curve.  Which of ``shares`` (see learn_dictionaries) is used, the log
    loss within the second half decides.  Only the drawn ids, of that bound,
    go to all tasks; only strong words, samples and features of the drawn
    texts come to the driver.  With labels of one kind, or none, scores are
    constant.
    """
    rows = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    have = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, ordinary = have.get(1, 0), have.get(0, 0)
    prior = toxic / (toxic + ordinary) if toxic + ordinary else 0.0
    if not toxic or not ordinary:
        return Model(b"", b"", np.zeros(0), np.zeros(0), np.zeros(0), prior)
    span = 1 << 20
    at = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(span))
    share = F.when(F.col("toxic") == 1, F.lit(int(span * min(1.0, toxic_rows / toxic)))).otherwise(F.lit(int(span * min(1.0, ordinary_rows / ordinary))))
    with scratch(docs.sparkSession):
        ids = F.broadcast(rows.where(at < share).dropDuplicates(["doc_id"]))
        drawn = docs.join(ids, "doc_id").select("text", "toxic").dropDuplicates(["text", "toxic"])
        drawn = written(drawn.withColumn("half", F.pmod(F.xxhash64(F.lit(12), "text"), F.lit(2))), "labelled")
        sizes = {(r["half"], r["toxic"]): r["n"] for r in drawn.groupBy("half", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        if any(not sizes.get((h, t)) for h in (0, 1) for t in (0, 1)):
            return Model(b"", b"", np.zeros(0), np.zeros(0), np.zeros(0), prior)
        common, marked = learn_dictionaries(drawn.where("half = 0"), sizes[0, 1], sizes[0, 0], (ordinary_bytes, toxic_bytes), shares, ratio, chance, window, drawn_windows)
        marked = list(dict.fromkeys(marked))

        def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for k, extra in enumerate(marked):
                    x = savings(pdf["text"], common, common + extra, window)
                    yield pd.DataFrame(x, columns=FEATURES).assign(toxic=pdf["toxic"].to_numpy(), way=k)

        seen = drawn.where("half = 1").mapInPandas(measure, ", ".join(f"{f} double" for f in FEATURES) + ", toxic int, way int").toPandas().sort_values(FEATURES)
    ways = [(x[FEATURES].to_numpy(), x["toxic"].to_numpy(float)) for x in (seen[seen["way"] == k] for k in range(len(marked)))]
    best = min(range(len(ways)), key=lambda k: log_loss(*ways[k], prior))
    return Model(common, common + marked[best], *fit_curve(*ways[best], prior), prior)


def toxicity(model: Model, text: Column, window: int = 64) -> Column:
    """The probability that ``text`` is toxic, over all its windows; null and empty texts are one empty window."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not model.toxic:
            return pd.Series(np.full(len(texts), model.prior))
        x = savings(texts, model.ordinary, model.toxic, window)
        z = (x - model.mean) / model.scale @ model.weights[:-1] + model.weights[-1]
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return score(text)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into ``fold`` of ``folds``; null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, toxic) of ids that aren't held out are learned from.
    Null and empty texts are one empty window, very long ones are scored by
    all their windows; rows that repeat an id are scored one by one; an empty
    table gives none.
    """
    out = held_out(F.col("doc_id"), 4, 2)
    model = train(docs.select("doc_id", "text"), labels.select("doc_id", "toxic").where(~out))
    scored = docs.select("doc_id", out.alias("held_out"), toxicity(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
