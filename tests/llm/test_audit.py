"""The filter audit against applying the filters in every order."""

from __future__ import annotations

import random
from collections import Counter
from fractions import Fraction
from itertools import permutations

from pyspark.sql import functions as F

from quillon.llm import audit

from .conftest import prose


def fails(rows):
    """The letters that each row fails."""
    out = []
    for i, text, _ in rows:
        text = text or ""
        words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in text).split(" ") if w]
        e = i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows)
        tests = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), any(c in "#$%&*|" for c in text), e]
        out.append({x for x, bad in zip("ABCDE", tests, strict=True) if bad})
    return out


def brute(rows, labels):
    good, toxic = ({i for i, *m in labels if m[k] == 1 and i is not None} for k in (0, 1))
    out, held, sums = [], fails(rows), Counter()
    parts = {s or "" for *_, s in rows}
    for part in parts:
        here = [(i, f) for (i, _, s), f in zip(rows, held, strict=True) if (s or "") == part]
        for order in permutations("ABCDE"):
            left = here
            for step, x in enumerate(order, 1):
                gone = [(i, f) for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                sums[part, x] += len(gone)
                out.append([part, "".join(order), step, len(left), len(gone), sum(x in f for _, f in here) - len(gone), sum(f == {x} for _, f in here), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), (part, x)])
    return Counter((*r[:-1], sums[r[-1]]) for r in out)


def test_equals_applying_the_filters(spark):
    rng = random.Random(13)
    texts = [None, "", " \t ", prose(1, 250), prose(2, 199), "word " * 300, prose(3, 210).upper(), prose(4, 220) + " #", "É" * 49 + "A", "É" * 50 + "A", "x|y", "日本語 " * 250, "a b\u0085c " * 99, prose(5, 260), prose(6, 200)]
    rows = [(k // 2 if k % 9 else None, rng.choice(texts), rng.choice(["web", "news", "", None])) for k in range(150)]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(60)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit(1) for c in ("part", "mask", "n", "id", "digest", "good", "toxic")})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("n", F.lit(1))
    assert Counter(map(tuple, audit.audit_filters(docs.repartition(4), marks).collect())) == brute(rows, labels)
    assert audit.audit_filters(docs.limit(0), marks).count() == 0
    assert Counter(map(tuple, audit.audit_filters(docs, marks.limit(0)).collect())) == brute(rows, [])


def test_shapley_values_are_means_over_orders():
    rng = random.Random(5)
    counts = {mask: (rng.randrange(100), 0, 0) for mask in range(32)}
    coefficients = audit.polynomial(audit.np.array([counts[m][0] for m in range(32)]))
    assert [audit.shapley(coefficients, i) for i in range(5)] == [sum(Fraction(n, m.bit_count()) for m, (n, *_) in counts.items() if m >> i & 1) for i in range(5)]
    assert audit.corners(coefficients)[31] == sum(n for m, (n, *_) in counts.items() if m)


def test_hot_texts_and_long_ones(spark):
    """Most rows are one text; texts of 5 MB."""
    long = prose(9, 900_000)
    assert len(long) > 4_500_000
    rows = [(k, "the same", "s") for k in range(300)] + [(900 + k, t, "s") for k, t in enumerate([long, long, "x" * 5_000_000, " " * 5_000_000, "same word " * 500_000])]
    got = audit.audit_filters(spark.createDataFrame(rows, "doc_id long, text string, source string"), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    steps = {r["step"]: r for r in got.where("filter_order = 'EABCD'").collect()}
    assert (steps[1]["removed"], steps[1]["kept"]) == (300, 5)
    assert (steps[2]["removed"], steps[3]["removed"], steps[5]["kept"]) == (3, 2, 0)
