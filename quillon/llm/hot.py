"""Keys that would fill a task by themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: Into how many groups the rows of a hot key are dealt.
SALTS = 64


def hot_keys(sample: DataFrame, key: str, tasks: int) -> list[int]:
    """Integer keys that have more than 1 / (4 ``tasks``) of the rows of ``sample``: at most 4 ``tasks``.

    ``sample`` is some share of the rows that are to be dealt by ``key``; it
    only tells which keys to deal further, so what a sample doesn't show costs
    time in a task, no rows.
    """
    seen = Observation()
    counts = sample.observe(seen, F.count(F.lit(1)).alias("rows")).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    most = counts.orderBy(F.desc("n")).limit(4 * tasks).collect()
    return sorted(r[key] for r in most if r["n"] * 4 * tasks > seen.get["rows"] and r["n"] > 16)


def salt(key: Column, keys: list[int], by: Column) -> Column:
    """-1, and for hot ``keys`` a number from 0 and below SALTS that follows from ``by``."""
    light = F.lit(-1).cast("long")
    return F.when(key.isin(keys), F.pmod(F.xxhash64(by), F.lit(SALTS))).otherwise(light) if keys else light


def join_totals(rows: DataFrame, totals: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with an aggregate by ``key``.

    The hash that is joined by as well isn't the aggregate's key, so both sides
    are shuffled for this join alone, and Spark splits a hot key's rows.
    """
    keyed = lambda df: df.withColumn("__q_hash", F.xxhash64(key))
    return keyed(rows).join(keyed(totals), ["__q_hash", key]).drop("__q_hash")


def tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
