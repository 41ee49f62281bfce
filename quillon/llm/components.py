"""Connected components of a table of links, by alternating star contraction.

Large star: every node links its larger neighbours to its smallest one.  Small
star: it links its smaller neighbours and itself to its smallest one.  Both keep
the components; in the end every node links to the smallest of its component.
A hot node's neighbours never meet in one task: the minimum is a map-side
aggregate, and the join back to it has shuffles of its own on both sides (its
key is not the aggregate's), so that Spark splits it where it is skewed.

Each star is a query of its own over a written table, and takes no more tasks
than its links need: the driver holds the metrics of every task and describes
every plan anew after each of its shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .hot import join_totals
from .storage import files_for, written


def _star(links: DataFrame, both: bool, rows: int) -> DataFrame:
    """``links``: a > b, a written table of ``rows`` rows.  Large star if ``both``, else small star."""
    sides, few = links.select(F.col("a").alias("u"), F.col("b").alias("v")), files_for(rows)
    if both:
        sides = links.select(F.inline(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))))
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).coalesce(few)
    at = join_totals(sides, least, "u").coalesce(few)
    if both:
        out = at.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = at.select(F.inline(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))))
    return out.where("a <> b").distinct()


def components(links: DataFrame, name: str = "components", rows: int | None = None, rounds: int = 100) -> DataFrame:
    """node, component (the smallest node of its component) for every node of ``links`` (a, b: comparable ids; nulls and loops no part); ``rows``: how many links there are at most, if known."""
    counted = Observation()
    apart = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = written(apart.observe(counted, F.count(F.lit(1)).alias("n")), name, rows)
    n, state = counted.get["n"], None
    for _ in range(rounds):
        seen = Observation()
        large = written(_star(now, True, n), name, n)  # no star makes more links than it is given
        turned = _star(large, False, n).observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("sum"))
        now = written(turned, name, n)
        n = seen.get["n"]
        total = n, seen.get["sum"]
        if total == state:
            break
        state = total
    else:
        raise RuntimeError(f"no end after {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
