"""Bit tables: a filter before a shuffle that may let others pass, but none out that belongs.

A table has 16 bits for each key, up to MOST bits in all; where keys are too
many for that to filter well, there is none, and rows are joined with the keys
as they are.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import written

#: 4 MB as an array, 16 MB as rows.
MOST = 1 << 25


def bits_for(keys: int) -> int:
    """The size of a table for so many ``keys``; 0 where they are too many for one."""
    return min(MOST, max(1 << 16, 1 << (16 * keys - 1).bit_length())) if keys <= MOST // 4 else 0


def position(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def _words(keys: DataFrame, key: str, bits: int) -> DataFrame:
    at = keys.select(position(F.col(key), bits).alias("at"))
    return at.groupBy(F.shiftright("at", 5).alias("__q_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 32 as int))")).alias("__q_held"))


def bit_table(keys: DataFrame, key: str, bits: int) -> np.ndarray:
    """The bits of all ``keys`` set in a table of ``bits``, at most 4 MB."""
    words = _words(keys, key, bits).toPandas()
    out = np.zeros(bits // 32, dtype="<u4")
    out[words["__q_word"].to_numpy(np.int64)] = words["__q_held"].to_numpy(np.int64).astype("<u4")
    return out.view(np.uint8)


def tested(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (table[at >> 3] >> (at & 7) & 1).astype(bool)


def divided(rows: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two: those that may have one of ``keys`` (a written table), and those that have none.

    The table is broadcast as at most MOST / 32 rows of 16 bytes (16 MB),
    whatever the number of keys; beyond that all rows may have one.
    """
    bits = bits_for(keys.count())
    if not bits:
        return rows, rows.limit(0)
    words = written(_words(keys, key, bits), "bits", 0, keep=True)
    names = [F.col(f"`{c}`") for c in rows.columns]
    at = rows.withColumn("__q_at", position(F.col(key), bits)).withColumn("__q_word", F.shiftright("__q_at", 5))
    hit = F.coalesce(F.expr("shiftright(__q_held, cast(__q_at % 32 as int)) & 1") == 1, F.lit(False))
    joined = at.join(F.broadcast(words), "__q_word", "left").withColumn("__q_hit", hit)
    return joined.where("__q_hit").select(*names), joined.where("not __q_hit").select(*names)


def without_keys(rows: DataFrame, keys: DataFrame, key: str, most: int | None = None) -> DataFrame:
    """The rows of ``rows`` (a table that can be read twice) whose ``key`` isn't in ``keys``; null keys stay.

    Only rows that the bit table can't clear are shuffled.  ``most``: how many
    keys there are at most, if known.
    """
    keys = written(keys.select(key).distinct(), "keys", most, keep=True)
    hit, clear = divided(rows, keys, key)
    return clear.unionByName(hit.join(keys.hint("merge"), key, "left_anti").select(*[F.col(f"`{c}`") for c in rows.columns]))
