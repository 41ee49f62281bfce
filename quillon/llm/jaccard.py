"""Exact n-gram Jaccard join as a blocked sparse matrix product.

The product of the document by n-gram incidence matrix with its transpose
holds every pair's overlap.  Size-derived bounds keep almost all of it from
being computed.  With threshold t, a set of n shingles can only link to one that
shares at least ceil(t n) with it.  So

1. documents with equal sets are one class, and one of them stands for it;
2. of any order of shingles, two linked sets share at least l of the first
   n - ceil(t n) + l of each.  In the order of hashes these are a quarter of all
   shingles; they are sorted by shingle once, and only those that another class
   has too go on;
3. classes with fewer than l of these left are dropped; of the others the
   rarest, all but l - 1, are the prefix;
4. every class is multiplied with the hubs (smallest classes) of its prefix
   columns; what links is a component so far, and classes that share a hub
   column form a cluster, which no link leaves;
5. in clusters of several components the rows are dealt into size bands; only
   neighbouring bands can link.  Blocks of bands are multiplied, accumulating
   overlap counts shingle by shingle and skipping pairs beyond the size bounds
   or in one component already.

4 and 5 are done twice.  First on what 2 left of the sets, where "links" means
that a pair shares as many of these as two linked sets must (enough_left());
clusters grow together by single passages as a corpus grows, but not these.
Then the components of that are the clusters, and only their classes' whole
sets are made, with "links" as defined.  Blocks are dealt in passes, so that
the rows dealt at once stay in proportion to the sets however large a cluster.

Linked copies so cost one product each, not one for each pair, and no pair of
texts in different components is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bits import bit_table, bits_for, position, tested, without_keys
from .components import components
from .hot import hot_keys, join_totals, salt, tasks
from .storage import scratch, written
from .words import distinct, mixed, shingles, slices

#: Of the sets' shingles, one in so many is left beside those that a link may lack.  A pass of blocks deals all rows so often at most, or so many shingles.
SPARE, FOLD, DEALT = 20, 4, 1 << 24


def needed(n: Column, percent: int) -> Column:
    """ceil(percent * n / 100)."""
    return F.floor((n * percent + 99) / F.lit(100)).cast("long")


def shingle_sets(docs: DataFrame, size: int, doc_id: str, text: str, spare: int | None, percent: int, only: np.ndarray | None = None) -> DataFrame:
    """row (a number of its own), doc_id, n (distinct shingles), s1 and s2 (a 128-bit signature of the set) and grams: all hashes, or with ``spare`` the smallest n - needed + floor(n / spare) + 1.

    ``only``, a bit table by hash of the id, leaves out rows whose bit isn't set.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            if only is not None:
                batch = batch.filter(pa.array(tested(only, batch.column(2).to_numpy())))
            for first, w, _, bounds in slices(batch.column(1)):
                rows = len(bounds) - 1
                row, h = distinct(*shingles(w, size))
                n = np.bincount(row, minlength=rows)
                starts = np.concatenate([[0], np.cumsum(n)])
                with np.errstate(over="ignore"):
                    total = lambda x: np.add.reduceat(np.append(x, np.uint64(0)), starts[:-1]) * (n > 0).astype(np.uint64)
                    s1, s2 = total(mixed(h + np.uint64(1))), total(mixed(h ^ np.uint64(0x5851F42D4C957F2D)))
                keep = n if spare is None else np.minimum(n, n + (-n * percent // 100) + n // spare + 1)
                kept = np.arange(len(h)) - starts[row] < keep[row]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(keep)]), pa.int32()), pa.array(h[kept].view(np.int64)))
                numbers = np.arange(number, number + rows)
                number += rows
                yield pa.RecordBatch.from_arrays([pa.array(numbers), batch.column(0).slice(first, rows), pa.array(n, pa.int64()), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), lists], names=["row", "doc_id", "n", "s1", "s2", "grams"])

    wanted = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if only is not None:
        wanted = wanted.withColumn("bit", position(F.col("doc_id"), len(only) * 8))
    return wanted.mapInArrow(make, f"row long, doc_id {id_type}, n long, s1 long, s2 long, grams array<long>")


def class_ids(rows: DataFrame, bits: int = 64, most: int | None = None, keep: bool = False) -> tuple[DataFrame, Column]:
    """Classes of equal (n, s1, s2), a written table: n, s1, s2, cid, doc_id (the least), first (the least row) and copies; and the expression of cid.

    cid is a hash of ``bits`` bits.  Classes whose hashes clash, N^2 / 2^65 of N
    classes, take another, and again until there are no clashes, so a cid is
    one class.
    """
    classes = rows.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("doc_id"), F.min("row").alias("first"), F.count(F.lit(1)).alias("copies"))
    classes = written(classes, "classes", most, keep)
    hashed = lambda seed: F.xxhash64(F.lit(seed), "n", "s1", "s2") if bits == 64 else F.pmod(F.xxhash64(F.lit(seed), "n", "s1", "s2"), F.lit(1 << bits))
    cid = hashed(0)
    for seed in range(1, 65):
        clashes = classes.select(cid.alias("cid"), hashed(0).alias("base")).groupBy("cid").agg(F.count(F.lit(1)).alias("n"), F.collect_set("base").alias("bases")).where("n > 1")
        moved = sorted({base for r in clashes.select("bases").collect() for base in r["bases"]})
        if not moved:
            return classes.withColumn("cid", cid), cid
        cid = F.when(hashed(0).isin(moved), hashed(seed)).otherwise(cid)
    raise RuntimeError("classes' ids still clash")


def repeated(rows: DataFrame, hot: list[int]) -> DataFrame:
    """Distinct rows (gram, cid, n) whose gram more than one cid has; rows of ``hot`` grams all.

    Sorted partitions are read as a stream, so a gram of any number of rows
    takes no memory but its first row's; hot grams are dealt over many.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, int, int, int] | None = None
        told = False  # whether the last row is out already
        for batch in batches:
            if not batch.num_rows:
                continue
            gram, cid, n, group = (batch.column(k).to_numpy() for k in range(4))
            if last is not None:
                gram, cid, n, group = (np.concatenate([[x], y]) for x, y in zip(last, (gram, cid, n, group), strict=True))
            fresh = np.ones(len(gram), dtype=bool)
            fresh[1:] = (gram[1:] != gram[:-1]) | (cid[1:] != cid[:-1])
            gram, cid, n, group = gram[fresh], cid[fresh], n[fresh], group[fresh]
            emit = np.zeros(len(gram), dtype=bool)
            emit[1:] = gram[1:] == gram[:-1]
            emit[:-1] |= emit[1:].copy()
            emit |= group >= 0
            ends_shared = bool(emit[-1]) or (told and len(gram) == 1)
            if told and last is not None:
                emit[0] = False
            told, last = ends_shared, (gram[-1], cid[-1], n[-1], group[-1])
            yield pa.RecordBatch.from_arrays([pa.array(x[emit]) for x in (gram, cid, n)], names=["gram", "cid", "n"])

    dealt = rows.select("gram", "cid", "n", salt(F.col("gram"), hot, F.col("cid")).alias("group"))
    return dealt.repartition("gram", "group").sortWithinPartitions("gram", "group", "cid").mapInArrow(keep, "gram long, cid long, n long")


def enough(n, m, overlap, percent: int, least):
    """Whether whole sets of ``n`` and ``m`` shingles that share ``overlap`` link; columns or arrays alike."""
    return 100 * overlap >= percent * (n + m - overlap)


def enough_left(n, m, overlap, percent: int, least):
    """Whether sets of ``n`` and ``m`` shingles may link that share ``overlap`` of the shingles that step 2 left.

    Linked sets share at least percent / (100 + percent) x (n + m).  Of the one
    whose list ends first, all that is shared is in the other's list too, and
    what isn't shared is at most the rest; so a list's length less that rest is
    the bound, here without rounding and less by at most 1.  ``least``: F.least
    or np.minimum.
    """
    rest = lambda x: least(x * 0.0, x / SPARE - x * (percent / 100) - 1.0)
    return overlap >= least(rest(n), rest(m)) + (n + m) * (percent / (100 + percent))


def block_links(ids: np.ndarray, sets: list[np.ndarray], n: np.ndarray, component: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int, links=enough) -> list[tuple[int, int]]:
    """Links between rows marked ``left`` and ``right`` that connect all of these that link, none within a ``component`` or found twice.

    The product of one row with all others is accumulated from the columns of
    its shingles.  ``n``: how many the whole sets have.
    """
    held_of = np.array([len(s) for s in sets])
    columns, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), held_of)
    starts = np.concatenate([[0], np.cumsum(held_of)])
    order = np.argsort(at, kind="stable")
    held, ends = owner[order], np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(columns)))])
    tops, out = np.unique(component, return_inverse=True)[1], []
    rows, others = np.flatnonzero(left), right
    if right.sum() < left.sum():
        rows, others = np.flatnonzero(right), left
    for row in rows:
        fits = others & (tops != tops[row]) & (100 * np.minimum(n, n[row]) >= percent * np.maximum(n, n[row]))
        if not fits.any():
            continue
        mine = at[starts[row] : starts[row + 1]]
        overlap = np.bincount(np.concatenate([held[ends[c] : ends[c + 1]] for c in mine]), minlength=len(sets))
        for hit in np.flatnonzero(fits & links(n, n[row], overlap, percent, np.minimum)):
            if tops[hit] != tops[row]:
                tops[tops == tops[hit]] = tops[row]
                out.append((int(ids[row]), int(ids[hit])))
    return out


def residual_links(nodes: DataFrame, sets: DataFrame, percent: int, block: int, links=enough, most: int | None = None) -> DataFrame:
    """Links (a, b) between components of a cluster; ``nodes``: node, n, cluster, component, ``sets``: cid, grams (all n of them, or some).

    A band of sizes is dealt into parts of at most about ``block`` rows and
    ``most`` (512 x ``block``) shingles; each pair of parts of a band, or of a
    band and the next, is a task.  A row goes to as many tasks as there are
    parts, so tasks are dealt in passes of at most FOLD times the shingles of
    all rows (or DEALT), each written before the next.
    """
    most = most or 512 * block
    if "held" not in nodes.columns:
        nodes = nodes.withColumn("held", F.col("n"))
    several = nodes.groupBy("cluster").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("cluster")
    width = math.log(101 / percent)
    rows = nodes.join(several, "cluster").withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.lit(width)))
    sizes = rows.groupBy("cluster", "band").agg(F.count(F.lit(1)).alias("m"), F.sum("held").alias("held"))
    sizes = sizes.withColumn("parts", F.greatest(F.floor((F.col("m") + block - 1) / F.lit(block)), F.floor(F.col("held") / F.lit(most)) + 1)).select("cluster", "band", "parts", "held")
    bands = Window.partitionBy("cluster").orderBy("band").rangeBetween(1, 1)
    below = Window.partitionBy("cluster").orderBy("band").rangeBetween(-1, -1)
    sizes = sizes.withColumn("above_parts", F.coalesce(F.max("parts").over(bands), F.lit(0))).withColumn("below_parts", F.coalesce(F.max("parts").over(below), F.lit(0)))
    told = sizes.agg(F.sum("held").alias("held"), F.sum(F.col("held") * (F.col("parts") + F.col("above_parts") + F.col("below_parts"))).alias("dealt")).first()
    passes = -(-(told["dealt"] or 0) // max(DEALT, FOLD * (told["held"] or 0))) or 1
    rows = rows.drop("held").join(sizes.drop("held"), ["cluster", "band"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))

    def upto(n):
        return F.when(n > 0, F.sequence(F.lit(0).cast("long"), F.greatest(n, F.lit(1)) - 1)).otherwise(F.array().cast("array<bigint>"))

    def task(band, left, right_band, right, as_left, as_right):
        return F.struct(band.alias("band"), left.alias("left"), right_band.alias("right_band"), right.alias("right"), as_left.alias("as_left"), as_right.alias("as_right"))

    band, part, yes, no = F.col("band"), F.col("part"), F.lit(True), F.lit(False)
    tasks = F.concat(
        F.transform(upto(F.col("parts")), lambda p: task(band, F.least(p, part), band, F.greatest(p, part), p >= part, p <= part)),
        F.transform(upto(F.col("above_parts")), lambda p: task(band, part, band + 1, p, yes, no)),
        F.transform(upto(F.col("below_parts")), lambda p: task(band - 1, p, band, part, no, yes)),
    )
    dealt = rows.withColumn("task", F.explode(tasks)).select("cluster", "node", "n", "component", "task.*")
    by = ["cluster", "band", "left", "right_band", "right"]

    def multiply(pdf: pd.DataFrame) -> pd.DataFrame:
        got = []
        if pdf["component"].nunique() > 1:
            got = block_links(pdf["node"].to_numpy(), [np.asarray(g) for g in pdf["grams"]], pdf["n"].to_numpy(), pdf["component"].to_numpy(), pdf["as_left"].to_numpy(bool), pdf["as_right"].to_numpy(bool), percent, links)
        return pd.DataFrame(got, columns=["a", "b"]).astype("int64")

    def found(dealt: DataFrame) -> DataFrame:
        return dealt.join(sets.select(F.col("cid").alias("node"), "grams"), "node").groupBy(*by).applyInPandas(multiply, "a long, b long")

    if passes == 1:
        return found(dealt)
    parts = [written(found(dealt.where(F.pmod(F.xxhash64(*by), F.lit(passes)) == k)), "blocks") for k in range(passes)]
    return reduce(DataFrame.unionByName, parts)


def candidates(shared: DataFrame, share) -> tuple[DataFrame, DataFrame]:
    """What is left of the classes that may link, cid, n and grams, and distinct pairs (cid, n, hub) of a class and the smallest one of a column of its prefix; ``shared``: gram, cid, n."""
    alive = shared.groupBy("cid").agg(F.count(F.lit(1)).alias("held"), F.first("n").alias("n")).where(F.col("held") >= share).select("cid")
    rows = shared.count()
    cells = written(shared.join(alive, "cid", "left_semi"), "cells", rows)
    again = cells.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = join_totals(cells, again, "gram").groupBy("cid", "n").agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("columns")).where(F.size("columns") >= share)
    left = written(ranked.select("cid", "n", F.col("columns.gram").alias("grams"), F.slice("columns.gram", F.lit(1), (F.size("columns") - share + 1).cast("int")).alias("prefix")), "left", rows, keep=True)
    prefix = left.select("cid", "n", F.explode("prefix").alias("gram"))
    hubs = prefix.groupBy("gram").agg(F.min("cid").alias("hub"))
    return left.drop("prefix"), written(join_totals(prefix, hubs, "gram").where("cid <> hub").select("cid", "n", "hub").distinct(), "pairs", rows, keep=True)


def hub_links(pairs: DataFrame, sets: DataFrame, percent: int, name: str, rows: int, links=enough) -> DataFrame:
    """Of ``pairs`` (cid, n, hub; about ``rows``) those that link, a written table; ``sets``: cid, n, grams."""
    hubs = sets.select(F.col("cid").alias("hub"), F.col("n").alias("hub_n"), F.col("grams").alias("hub_grams"))
    sized = pairs.join(hubs.select("hub", "hub_n"), "hub").where(100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")).select("cid", "n", "hub")
    near = sized.join(sets.select("cid", "grams"), "cid").join(hubs, "hub")
    overlap = F.size(F.array_intersect("grams", "hub_grams"))
    return written(near.where(links(F.col("n"), F.col("hub_n"), overlap, percent, F.least)).select("cid", "n", "hub"), name, rows)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("cid").alias("a"), F.col("hub").alias("b"))


def _placed(sets: DataFrame, clusters: DataFrame, linked: DataFrame, rows: int) -> DataFrame:
    """node, n, held, cluster and component (by ``linked``) of the nodes of ``clusters``, a written table."""
    nodes = sets.select(F.col("cid").alias("node"), "n", F.size("grams").cast("long").alias("held")).join(clusters.withColumnRenamed("component", "cluster"), "node").join(components(linked, "linked", rows), "node", "left")
    return written(nodes.withColumn("component", F.coalesce("component", "node")), "nodes", rows)


def near_links(pairs: DataFrame, left: DataFrame, percent: int, block: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """The ``pairs`` that may link by what is left of their sets, and links (a, b) with the same components as all pairs of classes that may."""
    close = hub_links(pairs, left, percent, "close", rows, enough_left)
    nodes = _placed(left, components(_ends(pairs), "clusters", rows), _ends(close), rows)
    return close, _ends(close).unionByName(residual_links(nodes, left, percent, 8 * block, enough_left, 512 * block))


def class_links(close: DataFrame, clusters: DataFrame, sets: DataFrame, percent: int, block: int, rows: int) -> DataFrame:
    """Links (a, b) between classes that have the same components as all links; ``close``: pairs to look at, ``clusters``: node, component, which no link leaves, ``sets``: cid, n, grams."""
    linked = _ends(hub_links(close, sets, percent, "linked", rows))
    return linked.unionByName(residual_links(_placed(sets, clusters, linked, rows), sets, percent, block))


def jaccard_components(docs: DataFrame, percent: int = 80, size: int = 5, block: int = 1024, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id for every row of ``docs``.

    Two documents link where 100 x overlap >= ``percent`` x union of their sets
    of ``size``-word shingles; ``component_id`` is the smallest id in reach.
    Null and empty texts have no shingle and link with nothing; repeated rows
    have equal sets and so link; a null id is reached through but is a
    component's id only where there is no other.  Texts of any length are read
    whole; an empty table gives none; other columns don't matter.  Shingles are 64-bit hashes, sets are
    equal if their 128-bit signatures and sizes are.
    """
    with scratch(docs.sparkSession):
        return written(_components(docs, percent, size, block, doc_id, text), "found", keep=True)


def _components(docs: DataFrame, percent: int, size: int, block: int, doc_id: str, text: str, bits: int = 64) -> DataFrame:
    seen = Observation()
    with scratch(docs.sparkSession):  # sets and cells are the largest tables and go before whole sets are made
        sets = written(shingle_sets(docs, size, doc_id, text, SPARE, percent).observe(seen, F.count(F.lit(1)).alias("rows")), "sets")
        n_rows = seen.get["rows"]
        heads = written(sets.drop("grams"), "heads", n_rows, keep=True)
        some = sets.where("n > 0")
        classes, cid = class_ids(heads.where("n > 0"), bits, n_rows, keep=True)
        copies = heads.where("n > 0").select("row", "n", "s1", "s2").join(classes.where("copies > 1").select("n", "s1", "s2", "first"), ["n", "s1", "s2"]).where("row <> first")
        single = without_keys(some, copies, "row", n_rows).select(cid.alias("cid"), "n", "row", "grams")
        grams = single.select("cid", "n", "row", F.explode("grams").alias("gram"))
        hot = hot_keys(grams.where(F.pmod(F.xxhash64("row"), F.lit(64)) == 0), "gram", tasks(docs))
        shared = written(repeated(grams, hot), "shared")
        share = F.floor(needed(F.col("n"), percent) / F.lit(SPARE)) + 1
        left, pairs = candidates(shared, share)
    n_pairs = pairs.count()
    close, near = near_links(pairs, left, percent, block, n_pairs)
    clusters = components(near, "near", n_pairs)
    asked = written(clusters.select(F.col("node").alias("cid")).join(classes.select("cid", "doc_id"), "cid"), "asked", 2 * n_pairs)
    if filtered := bits_for(asked.count()):
        full = shingle_sets(docs, size, doc_id, text, None, percent, bit_table(asked, "doc_id", filtered))
    else:
        ids = asked.select(F.col("doc_id").alias("__q_id")).distinct()
        full = shingle_sets(docs.join(ids, F.col(doc_id).eqNullSafe(F.col("__q_id")), "left_semi"), size, doc_id, text, None, percent)
    full = full.where("n > 0").select(cid.alias("cid"), "n", "grams")
    full = written(full.join(asked.select("cid"), "cid", "left_semi").dropDuplicates(["cid"]), "full")
    joined = components(class_links(close, clusters, full, percent, block, n_pairs), rows=2 * n_pairs)
    roots = joined.join(classes.select(F.col("cid").alias("node"), "doc_id"), "node")
    least = roots.groupBy("component").agg(F.min("doc_id").alias("root"))
    roots = join_totals(roots, least, "component").select(F.col("node").alias("cid"), "root")
    placed = written(classes.select("cid", "doc_id").join(roots, "cid", "left").select("cid", F.coalesce("root", "doc_id").alias("root")), "placed", n_rows)
    rows = heads.select("doc_id", "n", F.when(F.col("n") > 0, cid).alias("cid"))
    return rows.join(placed, "cid", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("root")).otherwise(F.col("doc_id")).alias("component_id"))
