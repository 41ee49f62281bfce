"""Whitening against exact rationals and the definition, on small and odd tables."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def vectors(n, d, seed=0):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + rng.normal(size=d) * 5
    return [(k, [float(np.float32(c)) for c in row]) for k, row in enumerate(mixed)]


def whole(rows):
    return {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)}


def test_equals_the_definition(spark):
    odd = [(1000, None), (1001, [None] * 6), (1002, [1.0] * 5 + [float("nan")]), (1003, [float("inf")] + [0.0] * 5), (1004, [0.5] * 5 + [None]), (1005, [1.0, 2.0]), (1006, [])]
    rows = vectors(200, 6)
    named = {c: F.lit(1) for c in ("x", "part", "n", "whitened", "deviation")}
    got = {r["vec_id"]: r for r in whitening.whiten(spark.createDataFrame(rows + odd, SCHEMA).withColumns(named).repartition(3)).collect()}
    x = whole(rows)
    n, s = len(x), [sum(c) for c in zip(*x.values(), strict=True)]
    assert got.keys() == x.keys() and {r["n"] for r in got.values()} == {n}
    assert all(got[i]["deviation"] == sum((n * c - t) ** 2 for c, t in zip(v, s, strict=True)) for i, v in x.items())
    centred = np.array([[float(Fraction(n * c - t, n)) for c, t in zip(v, s, strict=True)] for v in x.values()])
    v = centred.T @ centred / n
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1], basis[:, ::-1]
    w = np.array([got[i]["whitened"] for i in x])
    want = centred @ basis / np.sqrt(values)
    assert np.abs(w - want * np.sign((w * want).sum(0))).max() < 1e-9
    assert np.abs(w.T @ w / n - np.eye(6)).max() < 1e-9
    assert np.allclose(next(iter(got.values()))["explained"], values / values.sum(), rtol=1e-9)
    assert all(r["identity_error"] < 1e-9 for r in got.values())


def test_only_the_first_components(spark):
    rows = whitening.whiten(spark.createDataFrame(vectors(80, 40, 1), SCHEMA), most=32).collect()
    assert {len(r["whitened"]) for r in rows} == {32} and rows[0]["identity_error"] < 1e-9
    assert 0 < sum(rows[0]["explained"]) < 1 and rows[0]["explained"] == sorted(rows[0]["explained"], reverse=True)


def test_fewer_directions_than_dimensions(spark):
    """Copied dimensions, fewer rows than dimensions, copies alone, repeated rows and null ids."""
    rows = [(i, v + v) for i, v in vectors(50, 3, 2)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {len(r["whitened"]) for r in got} == {3} and got[0]["identity_error"] < 1e-6
    assert {len(r["whitened"]) for r in whitening.whiten(spark.createDataFrame(vectors(4, 9), SCHEMA)).collect()} == {3}
    same = whitening.whiten(spark.createDataFrame([(1, [1.5, 2.5])] * 2 + [(None, [1.5, 2.5])], SCHEMA)).collect()
    assert sorted(map(str, ((r["vec_id"], r["n"], int(r["deviation"]), r["whitened"]) for r in same))) == sorted(map(str, [(1, 3, 0, []), (1, 3, 0, []), (None, 3, 0, [])]))


def test_empty_tables(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [float("nan")])]):
        got = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
        assert got.count() == 0 and got.columns == ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_numbers_are_exact(spark):
    """Beyond 64 bits sums and squares are still exact; what has no 62 bits raises."""
    rows = [(1, [2.0**53, 1.0]), (2, [-(2.0**53), 3.0]), (3, [2.0**52, -5.0])]
    x = whole(rows)
    s = [sum(c) for c in zip(*x.values(), strict=True)]
    got = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {i: sum((3 * c - t) ** 2 for c, t in zip(v, s, strict=True)) for i, v in x.items()} and max(got.values()) > 1 << 63
    with pytest.raises(Exception, match="64-bit"):
        whitening.whiten(spark.createDataFrame([(1, [2.0**60])], "vec_id long, embedding array<double>"))


def test_query(spark):
    from quillon.llm.queries import QUERIES

    got = QUERIES["op11_embedding_whitening"](spark, "/root/testdata/sf0.001")
    assert [f"{f.name} {f.dataType.simpleString()}" for f in got.schema] == ["vec_id bigint", "component int", "n bigint", "deviation bigint", "whitened double", "explained double", "identity_error double"]
    rows = got.collect()
    assert len(rows) == 500 * 32 and {r["component"] for r in rows} == set(range(1, 33)) and rows[0]["identity_error"] < 1e-4
