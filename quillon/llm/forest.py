"""Near duplicates through an LSH forest of MinHash signatures, each link confirmed on full sets.

Every tree is one order of all distinct sets by a signature of DEPTH min-hashes.
Tasks read the sorted orders and keep the sets whose longest common prefix with
a neighbour has at least LEAST min-hashes.  Sets with one such prefix are a
region.  In each round

1. every set is compared with its region's hub (the smallest id); what links is
   a component so far, and a region of one component is done;
2. a region of several components and at most ``block`` sets is compared as one
   block, but for pairs in one component or beyond the bounds of size: up to
   FEW sets as pairs, more as a product in one task, since pairs would grow with
   the square of a group of near copies; regions of the same sets count once;
3. a larger one goes a min-hash deeper, so its sets meet only where they have
   more in common; those still larger at full DEPTH are compared in blocks
   whatever their number.

A pair at the threshold j is in no common region only if all trees part it
before the depth to which its region went: less than (1 - j^DEPTH)^TREES, 3e-7
at 0.85, and 6e-14 where regions are small and stay at LEAST.  No number of
partners, candidates or copies is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .bits import bit_table, bits_for, without_keys
from .components import components
from .hot import join_totals
from .jaccard import class_ids, residual_links, shingle_sets
from .storage import scratch, written
from .words import mixed

TREES, DEPTH, LEAST = 32, 6, 3
#: Bytes of a min-hash; that different ones agree by chance has a probability of 2^-16.
WIDTH = 2
#: Sets of a region that are compared as pairs, at most (FEW - 1) / 2 for each of its rows.
FEW = 4


def signatures(grams: np.ndarray, starts: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """A row of ``trees`` x ``depth`` min-hashes of 16 bits for each run of ``grams`` from ``starts``, none of them empty.

    Grams are hashes already, so that a multiplier of its own orders them anew for each min-hash.
    """
    rng = np.random.default_rng(12)
    flips, factors = rng.integers(0, 1 << 63, (2, trees * depth), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((len(starts), trees * depth), ">u2")
    with np.errstate(over="ignore"):
        for k, (flip, factor) in enumerate(zip(flips, factors, strict=True)):
            least = np.minimum.reduceat((grams ^ flip) * factor, starts)
            out[:, k] = (mixed(least) >> np.uint64(48)).astype(np.uint16)
    return out


def signed(sets: DataFrame, trees: int, depth: int, at_most: int = 1 << 17) -> DataFrame:
    """row, doc_id, n, s1, s2 and sig (all trees' min-hashes; none for an empty set) of shingle sets; work goes over about ``at_most`` shingles at a time."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(5)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            grams = lists.flatten().to_numpy().view(np.uint64)
            ends = np.cumsum(sizes)
            sigs, first = [], 0
            while first < len(sizes):
                begin = ends[first] - sizes[first]
                end = max(first + 1, int(np.searchsorted(ends, begin + at_most, side="right")))
                part = sizes[first:end]
                starts = (np.cumsum(part) - part)[part > 0]
                found = iter(signatures(grams[begin : ends[end - 1]], starts, trees, depth)) if len(starts) else iter(())
                sigs += [next(found).tobytes() if n else b"" for n in part]
                first = end
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(5)), pa.array(sigs, pa.binary())], names=["row", "doc_id", "n", "s1", "s2", "sig"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sets.schema.fields[:5])
    return sets.mapInArrow(make, f"{fields}, sig binary")


def neighbours(single: DataFrame, trees: int, depth: int, least: int) -> DataFrame:
    """tree, sig, cid, n of the sets that share ``least`` min-hashes or more with a neighbour in the tree's order.

    Orders are cut into ranges of any places, so a common signature fills no
    task; the first and last set of a range have a neighbour out of sight and
    are kept.
    """
    width = depth * WIDTH
    keys = single.select("cid", "n", "sig", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    keys = keys.select("tree", F.expr(f"substring(sig, tree * {width} + 1, {width})").alias("sig"), "cid", "n")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, alike_before = None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            rows = pa.concat_tables([last, table]).combine_chunks() if last is not None else table
            tree = rows.column("tree").to_numpy()
            sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(len(tree), width)[:, : least * WIDTH]
            alike = (tree[1:] == tree[:-1]) & (sig[1:] == sig[:-1]).all(1)
            kept = np.concatenate([[alike_before], alike[:-1]]) | alike if len(alike) else np.zeros(0, bool)
            yield from rows.slice(0, len(kept)).filter(pa.array(kept)).to_batches()
            alike_before = bool(alike[-1]) if len(alike) else alike_before
            last = rows.slice(len(tree) - 1)
        if last is not None:
            yield from last.to_batches()

    ordered = keys.repartitionByRange("tree", "sig", "cid").sortWithinPartitions("tree", "sig", "cid")
    return ordered.mapInArrow(keep, "tree int, sig binary, cid long, n long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets link; ``sets``: cid, n, grams."""
    side = lambda s: sets.select(F.col("cid").alias(s), F.col("n").alias(f"n_{s}"), F.col("grams").alias(f"grams_{s}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b")
    both = F.size(F.array_intersect("grams_a", "grams_b"))
    return near.where(100 * both >= percent * (F.col("n_a") + F.col("n_b") - both)).select("a", "b")


def fits(n: str, other: str, percent: int):
    """Whether sets of these sizes can link."""
    return 100 * F.least(n, other) >= percent * F.greatest(n, other)


def hub_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of a set and its region's hub, where they are of two components; ``rows``: region, cid, n, component."""
    hubs = rows.groupBy("region").agg(F.min(F.struct("cid", "n", "component")).alias("hub"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("region", "hub")
    met = join_totals(rows, hubs, "region").select("cid", "n", "component", "hub.cid", "hub.n", "hub.component").toDF("a", "n", "component", "b", "hub_n", "hub_component")
    return met.where((F.col("component") != F.col("hub_component")) & fits("n", "hub_n", percent)).select("a", "b").distinct()


def blocks(rows: DataFrame) -> DataFrame:
    """cluster, others (cid, n and component, by cid) and m (their number) of the distinct groups of sets that are regions of several components; ``rows``: as in hub_pairs(), of regions of bounded size."""
    members = rows.groupBy("region").agg(F.array_sort(F.collect_list(F.struct("cid", "n", "component"))).alias("others"), F.min("component").alias("low"), F.max("component").alias("high"))
    return members.where("low <> high").select(F.xxhash64("others.cid").alias("cluster"), "others", F.size("others").alias("m")).distinct()


def block_pairs(blocks: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of two components within a block; ``blocks``: others, of few sets."""
    one = blocks.select(F.explode("others").alias("m"), "others")
    other = one.select("m", F.explode(F.filter("others", lambda o: (o["cid"] > F.col("m.cid")) & (o["component"] != F.col("m.component")) & (100 * F.least(o["n"], F.col("m.n")) >= percent * F.greatest(o["n"], F.col("m.n"))))).alias("o"))
    return other.select(F.col("m.cid").alias("a"), F.col("o.cid").alias("b")).distinct()


def forest_links(near: DataFrame, sets: DataFrame, percent: int, depth: int, least: int, block: int) -> DataFrame:
    """Links (a, b), confirmed, with the components of all links that regions hold; ``near``: as from neighbours()."""
    spark = near.sparkSession
    links, tops, pending = spark.createDataFrame([], "a long, b long"), None, near
    none = spark.createDataFrame([], "region long, cid long, n long, component long")
    small, large = none, none
    for level in range(least, depth + 1):
        region = F.xxhash64("tree", F.lit(level), F.expr(f"substring(sig, 1, {level * WIDTH})"))
        at = written(pending.withColumn("region", region), "regions")

        def placed(rows: DataFrame) -> DataFrame:
            if tops is None:
                return rows.withColumn("component", F.col("cid"))
            return rows.join(tops.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))

        found = written(confirmed(hub_pairs(placed(at).select("region", "cid", "n", "component"), percent), sets, percent), "links")
        links = links.unionByName(found)
        tops = written(components(links), "tops")
        now = written(placed(at), "placed")
        several = now.groupBy("region").agg(F.count(F.lit(1)).alias("m"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("region", "m")
        left = written(join_totals(now, several, "region"), "left")
        small = small.unionByName(left.where(F.col("m") <= block).select("region", "cid", "n", "component"))
        deeper = left.where(F.col("m") > block)
        if deeper.isEmpty():
            break
        large, pending = deeper.select("region", "cid", "n", "component"), deeper.select("tree", "sig", "cid", "n")
    else:
        nodes = large.select(F.col("cid").alias("node"), "n", F.col("region").alias("cluster"), "component")
        links = links.unionByName(residual_links(nodes, sets, percent, 16 * block))
    # What later rounds linked is a component now.
    small = written(blocks(small.drop("component").join(tops.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))), "blocks")
    nodes = small.where(F.col("m") > FEW).select("cluster", F.explode("others").alias("o")).select(F.col("o.cid").alias("node"), "o.n", "cluster", "o.component")
    links = links.unionByName(residual_links(nodes, sets, percent, 16 * block))
    return links.unionByName(confirmed(block_pairs(small.where(F.col("m") <= FEW), percent), sets, percent))


def near_duplicates(docs: DataFrame, percent: int = 85, size: int = 3, trees: int = TREES, depth: int = DEPTH, least: int = LEAST, block: int = 64, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the component's own id) for every row of ``docs``.

    Two documents link where 100 x overlap >= ``percent`` x union of their sets
    of ``size``-word shingles, confirmed on the sets.  Null and empty texts
    link with nothing; repeated rows have equal sets, so they link and share
    what ``kept`` says; a null id is reached through, is a component's id only
    where there is no other, and is kept then.  Texts of any length are read
    whole; an empty table gives none; other columns don't matter.  Shingles
    are 64-bit hashes, sets are equal if their 128-bit signatures and sizes are.
    """
    with scratch(docs.sparkSession):
        return written(_near_duplicates(docs, percent, size, trees, depth, least, block, doc_id, text), "found", keep=True)


def _near_duplicates(docs: DataFrame, percent: int, size: int, trees: int, depth: int, least: int, block: int, doc_id: str, text: str) -> DataFrame:
    seen = Observation()
    all_grams = shingle_sets(docs, size, doc_id, text, None, percent)
    sets = written(signed(all_grams, trees, depth).observe(seen, F.count(F.lit(1)).alias("rows")), "sets")
    some, rows = sets.where("n > 0"), seen.get["rows"]
    classes, cid = class_ids(some, most=rows)
    copies = some.select("row", "n", "s1", "s2").join(classes.where("copies > 1").select("n", "s1", "s2", "first"), ["n", "s1", "s2"]).where("row <> first")
    single = without_keys(some, copies, "row", rows).select(cid.alias("cid"), "n", "sig")
    near = written(neighbours(single, trees, depth, least), "near")
    asked = near.select("cid").distinct()
    asked = written(asked.join(classes.select("cid", "doc_id"), "cid"), "asked", rows)
    if bits := bits_for(asked.count()):
        full = shingle_sets(docs, size, doc_id, text, None, percent, bit_table(asked, "doc_id", bits))
    else:
        ids = asked.select(F.col("doc_id").alias("__q_id")).distinct()
        full = shingle_sets(docs.join(ids, F.col(doc_id).eqNullSafe(F.col("__q_id")), "left_semi"), size, doc_id, text, None, percent)
    full = full.where("n > 0").select(cid.alias("cid"), "n", "grams")
    full = written(full.join(asked.select("cid"), "cid", "left_semi").dropDuplicates(["cid"]), "full")
    joined = components(forest_links(near, full, percent, depth, least, block))
    roots = joined.join(classes.select(F.col("cid").alias("node"), "doc_id"), "node")
    lowest = roots.groupBy("component").agg(F.min("doc_id").alias("root"))
    roots = join_totals(roots, lowest, "component").select(F.col("node").alias("cid"), "root")
    placed = written(classes.select("cid", "doc_id").join(roots, "cid", "left").select("cid", F.coalesce("root", "doc_id").alias("root")), "placed", rows)
    out = sets.select("doc_id", "n", F.when(F.col("n") > 0, cid).alias("cid")).join(placed, "cid", "left")
    component = F.when(F.col("n") > 0, F.col("root")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
