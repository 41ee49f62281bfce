"""Whitening of embeddings: exact integer means, centred covariance, eigenvectors, projection.

Vectors become whole numbers first, so their sums are exact.  A second pass adds
up outer products of centred vectors, one matrix product for each batch; partial
results merge in a tree, so the driver gets a few matrices whose size depends on
the dimension alone.  The eigenvectors (LAPACK's symmetric solver) go out as one
broadcast of dimension x components numbers.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import scratch, written

#: Whole numbers of this size or more have no 64-bit sums of two.
LARGEST = 1 << 62
#: An eigenvalue below this share of the largest one is rounding, no direction in the data.
LEAST_SHARE = 1e-10


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """Lists of ``dimension`` numbers without nulls, as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def integers(vectors: DataFrame, vec_id: str, embedding: str, scale: int, offset: int) -> DataFrame:
    """vec_id and x = floor(scale c) + offset for vectors without null and non-finite entries."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            entries = lists.flatten().cast(pa.float64())
            c = entries.fill_null(np.nan).to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            whole = np.bincount(owner[~np.isfinite(c)], minlength=len(sizes)) == 0
            whole &= lists.is_valid().to_numpy(zero_copy_only=False)
            x = np.floor(scale * c[whole[owner]])
            if len(x) and np.abs(x).max() >= LARGEST - abs(offset):
                raise ValueError("entries beyond 64-bit whole numbers")
            bounds = np.concatenate([[0], np.cumsum(sizes[whole])])
            out = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x.astype(np.int64) + offset))
            yield pa.RecordBatch.from_arrays([ids.filter(pa.array(whole)), out], names=["vec_id", "x"])

    kind = vectors.schema[vec_id].dataType.simpleString()
    return vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("x")).mapInArrow(convert, f"vec_id {kind}, x array<long>")


def merged(rows: DataFrame, step: Callable[[pa.RecordBatch], Any], merge: Callable[[Any, Any], Any]) -> Any:
    """The results of ``step`` over all batches of ``rows``, merged within tasks and then in a tree; None where there are none."""

    def both(a: Any, b: Any) -> Any:
        return b if a is None else a if b is None else merge(a, b)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if batch.num_rows:
                state = both(state, step(batch))
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(state)], pa.binary())], names=["part"])

    return rows.mapInArrow(part, "part binary").rdd.treeAggregate(None, lambda a, r: both(a, pickle.loads(r[0])), both)


class Fit(NamedTuple):
    """n vectors; per dimension S = n floor + rest; the largest distance of an entry from ``floor``."""

    n: int
    floor: np.ndarray
    rest: np.ndarray
    reach: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: 64-bit numbers where they do, else Python's."""
        y = x - self.floor
        if self.n * (self.reach + 1) >= LARGEST:
            y = y.astype(object)
        return self.n * y - self.rest

    def deviations(self, centred: np.ndarray) -> pa.Array:
        """The sums of squares of rows of n x - S, exact."""
        if centred.shape[1] * (self.n * (self.reach + 1)) ** 2 < 1 << 63:
            return pa.array((centred * centred).sum(1)).cast(pa.decimal128(38, 0))
        wide = centred.astype(object)
        return pa.array([Decimal(int(v)) for v in (wide * wide).sum(1)], pa.decimal128(38, 0))


def fitted(rows: DataFrame, dimension: int) -> Fit:
    """First pass: exact sums, in halves of 32 bits, and the range of each dimension."""

    def sums(batch: pa.RecordBatch) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        x = matrix(batch.column(0), dimension)
        exact = (x >> 32).sum(0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(0).astype(object)
        return len(x), exact, x.min(0), x.max(0)

    n, total, low, high = merged(rows, sums, lambda a, b: (a[0] + b[0], a[1] + b[1], np.minimum(a[2], b[2]), np.maximum(a[3], b[3])))
    floor = (total // n).astype(np.int64)
    reach = max(max(int(h) - int(f), int(f) - int(m)) for m, f, h in zip(low, floor, high, strict=True))
    return Fit(n, floor, (total % n).astype(np.int64), reach)


def covariance(rows: DataFrame, n: int, centre: Callable[[pa.Array], np.ndarray]) -> np.ndarray:
    """Second pass: the sum of outer products of centred rows over ``n``."""

    def product(batch: pa.RecordBatch) -> np.ndarray:
        c = centre(batch.column(0))
        return c.T @ c

    total = merged(rows, product, np.add) / n
    return (total + total.T) / 2


def components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues from the largest down and their unit eigenvectors as columns, at most ``most``."""
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    real = int((values > LEAST_SHARE * max(values[0], 0.0)).sum())
    return values[:real], vectors[:, :real]


def whiten(vectors: DataFrame, most: int = 32, scale: int = 64, offset: int = 1_000_000, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, n, deviation decimal(38, 0), whitened and explained arrays by component, and identity_error, for each vector.

    All vectors without null and non-finite entries are fitted and returned,
    repeated rows and null ids too; of vectors of several lengths, those of the
    commonest (ties: the longest) take part.  Components are those of the
    largest eigenvalues, at most ``most``, less where the data have fewer
    directions (eigenvalues above LEAST_SHARE of the largest): copies of one
    vector have none and empty arrays.  No vectors, no rows.  Entries whose
    64-fold has no 62 bits raise; other columns don't matter.

    The vectors are read once; as whole numbers and as projections they are
    written to the shared folder, and ``identity_error`` is measured on the
    projections as written.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[vec_id].dataType.simpleString()
    with scratch(spark):
        rows = written(integers(vectors, vec_id, embedding, scale, offset), "integers")
        lengths = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
        if lengths is None or lengths["length"] == 0:
            return spark.createDataFrame([], f"vec_id {kind}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double")
        dimension = lengths["length"]
        rows = rows.where(F.size("x") == dimension)
        fit = fitted(rows.select("x"), dimension)
        v = covariance(rows.select("x"), fit.n, lambda x: (fit.centred(matrix(x, dimension)) / fit.n).astype(np.float64))
        values, basis = components(v, most)
        sent = spark.sparkContext.broadcast(basis / np.sqrt(values))

        def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                centred = fit.centred(matrix(batch.column(1), dimension))
                w = (centred / fit.n).astype(np.float64) @ sent.value
                bounds = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0), fit.deviations(centred), pa.ListArray.from_arrays(bounds, pa.array(w.ravel()))], names=["vec_id", "deviation", "whitened"])

        projected = written(rows.mapInArrow(project, f"vec_id {kind}, deviation decimal(38,0), whitened array<double>"), "whitened", keep=True)
        error = 0.0
        if found := len(values):
            mean = merged(projected.select("whitened"), lambda batch: matrix(batch.column(0), found).sum(0), np.add) / fit.n
            unit = covariance(projected.select("whitened"), fit.n, lambda w: matrix(w, found) - mean)
            error = float(np.abs(unit - np.eye(found)).max())
    explained = F.array(*[F.lit(float(e)) for e in values / np.trace(v)]).cast("array<double>")
    return projected.select("vec_id", F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))
