"""How quality filters interact: what each removes in every order, and its Shapley value.

A document's mask tells which filters it fails.  The documents of a part that a
set of filters S removes are v(S); the multilinear extension of v is

    v(x) = sum over masks m of count(m) (1 - prod over i in m of (1 - x_i))

and the coefficient of prod over i in S of x_i is (-1)^(|S|+1) times the number
of documents that fail all of S.  Its value at the corner of S is what S
removes; the integral of its derivative by x_i along the diagonal is the Shapley
value of filter i, here the sum over S with i of coefficient / |S|.  Only the
counts of the masks (at most 2^5 for each part) are gathered, after partial
aggregation; a part of any share of the rows is no more work than another.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import written

#: The filters in the order of their bits.
FILTERS = "ABCDE"


def failed(text: Column) -> Column:
    """The mask of the filters A to D that a text fails.

    A: fewer than 200 words; B: less than half of the words are distinct; C:
    more than 2 of 100 code points are A-Z; D: has one of ``#$%&*|``.
    """
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    by_words = lambda w: F.when(F.size(w) < 200, 1).otherwise(0) + F.when(F.size(F.array_distinct(w)) * 100 < F.size(w) * 50, 2).otherwise(0)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") * 100 > F.length(text).cast("long") * 2
    return F.transform(F.array(words), by_words)[0] + F.when(capitals, 4).otherwise(0) + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0)


def masks(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """part, mask, n, good and toxic: documents of each part (null: empty string) and mask, and how many are labelled quality 1 and toxic 1.

    Filter E: a document of smaller id has the same text (SHA-256 of the whole
    text) anywhere in the table; a null id is no smaller and no larger than
    another.  The hash beside the digest keeps the join's shuffle its own, so a
    text that many documents have is split over tasks.  Rows of documents count each;
    several labels of an id count once.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.unhex(F.sha2(text, 256))
    rows = written(docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), failed(text).alias("mask"), digest.alias("digest"), F.xxhash64(digest).alias("hash")), "masks")
    first = rows.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select(F.xxhash64("digest").alias("hash"), "digest", "first")
    repeats = F.when(F.col("id") > F.col("first"), 1 << FILTERS.index("E")).otherwise(0)
    marked = rows.join(first, ["hash", "digest"], "left").select("id", "part", (F.col("mask") + repeats).alias("mask"))
    known = labels.where("quality = 1 or toxic = 1").groupBy(F.col("doc_id").alias("id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic"))
    held = marked.join(known, "id", "left")
    total = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c)
    return held.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), total("good"), total("toxic"))


def polynomial(counts: np.ndarray) -> np.ndarray:
    """Coefficients of the removal polynomial by set of filters (bits), from counts by mask."""
    sets = np.arange(len(counts))
    fails_all = np.array([counts[(sets & s) == s].sum() for s in sets])
    signs = np.array([(-1) ** (int(s).bit_count() + 1) for s in sets])
    return np.where(sets > 0, signs * fails_all, 0)


def corners(coefficients: np.ndarray) -> np.ndarray:
    """The polynomial's value where the filters of a set are 1 and the others 0, by set."""
    sets = np.arange(len(coefficients))
    return np.array([coefficients[(sets & s) == sets].sum() for s in sets])


def shapley(coefficients: np.ndarray, i: int) -> Fraction:
    """The integral from 0 to 1 of the derivative by x_i at (t, ..., t)."""
    with_i = [s for s in range(len(coefficients)) if s >> i & 1]
    return sum((Fraction(int(coefficients[s]), s.bit_count()) for s in with_i), Fraction(0))


def effects(counts: dict[int, tuple[int, int, int]], filters: int = len(FILTERS)) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley x filters!) for every order and step; ``counts``: mask to (all, good, toxic)."""
    table = np.zeros((3, 1 << filters), np.int64)
    for mask, n in counts.items():
        table[:, mask] = n
    polynomials = [polynomial(row) for row in table]
    gone, good, toxic = (corners(p) for p in polynomials)
    orders, total, out = factorial(filters), int(table[0].sum()), []
    shares = [shapley(polynomials[0], i) * orders for i in range(filters)]
    for order in permutations(range(filters)):
        before = 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            removed = gone[after] - gone[before]
            out.append((order, step, total - gone[after], removed, gone[1 << i] - removed, table[0][1 << i], good[after] - good[before], toxic[after] - toxic[before], int(shares[i])))
            before = after
    return out


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """part, filter_order, step and the counts of that step for each part of ``docs``, all 120 orders and 5 steps.

    ``shapley`` is the Shapley value of the step's filter times 120, which is
    what it removes summed over all orders.  Texts are read whole, null counts
    as empty, and so does a null ``part``; repeated rows count each and are no
    copies of one another (ids aren't smaller); other columns don't matter; an
    empty table gives no rows.
    """
    counted = masks(docs.select("doc_id", "text", part), labels.select("doc_id", "quality", "toxic"), part)
    gathered = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    letters = {order: "".join(FILTERS[i] for i in order) for order in permutations(range(len(FILTERS)))}

    def steps(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
        for frame in frames:
            for name, counts in zip(frame["part"], frame["counts"], strict=True):
                got = pd.DataFrame(effects({c["mask"]: (c["n"], c["good"], c["toxic"]) for c in counts}), columns=names)
                got.insert(0, "filter_order", got.pop("order").map(letters))
                got.insert(0, "part", name)
                yield got

    return gathered.mapInPandas(steps, "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long")
