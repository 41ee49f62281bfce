"""Exact top-k inner products by best-first search over M-trees.

Vectors belong to the nearest of some pivots, and the vectors of a pivot are
dealt over trees of bounded size, so a tree covers a small ball where the data
have balls.  A node is a page: its routing vector, its covering radius r, its
distance to the parent's routing vector and, in leaves, the vectors.  For a
query q and any x under a node with routing vector o and parent p,
Cauchy-Schwarz and the triangle inequality give

    q.x <= q.o + |q| r      and, before q.o is known,
    q.x <= q.p + |q| (d(o, p) + r),

so stored parent distances rule pages out without a product.  A query first
searches the tree whose bound is highest; its k-th best score there is the floor
that whole trees, then inner pages, then leaves have to reach.  Leaves are
opened in the order of their bounds, the k-th best score rising.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import scratch, written

PAGES = "tree long, node int, parent int, leaf boolean, radius double, to_parent double, routing binary, ats binary, ids binary, vectors binary"
FOUND = "asked long, vec_id long, score long"
LOWEST = -(1 << 63)


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component as double; null for vectors that are null or hold null or non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(vector.isNotNull() & fine, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def matrix(rows: pd.Series) -> np.ndarray:
    """Rows of one width; shorter ones are filled up with zeros."""
    width = max(map(len, rows), default=0)
    out = np.zeros((len(rows), width), dtype=np.int64)
    for k, row in enumerate(rows):
        out[k, : len(row)] = row
    return out


def stacked(raws: pd.Series, dims: int) -> np.ndarray:
    """Vectors from columns of their bytes."""
    return np.frombuffer(b"".join(raws), dtype=np.int64).reshape(-1, dims)


def distances(rows: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(((rows.astype(np.float64) - to.astype(np.float64)) ** 2).sum(1))


def grow(vectors: np.ndarray, fanout: int, page: int) -> list[tuple]:
    """Pages (node, parent, leaf, radius, to_parent, routing row, member rows), parents first."""
    out: list[tuple] = []
    todo = [(np.arange(len(vectors)), 0, -1, 0.0)]
    while todo:
        rows, routing, parent, to_parent = todo.pop(0)
        radius = float(distances(vectors[rows], vectors[routing]).max(initial=0.0))
        node, leaf = len(out), len(rows) <= page
        out.append((node, parent, leaf, radius, to_parent, routing, rows if leaf else rows[:0]))
        if leaf:
            continue
        pivots = [rows[0]]
        nearest = distances(vectors[rows], vectors[rows[0]])
        owner = np.zeros(len(rows), dtype=np.int64)
        while len(pivots) < fanout and nearest.max() > 0:
            pivots.append(rows[int(nearest.argmax())])
            away = distances(vectors[rows], vectors[pivots[-1]])
            owner[away < nearest] = len(pivots) - 1
            nearest = np.minimum(nearest, away)
        parts = [rows[owner == k] for k in range(len(pivots))]
        if len(pivots) == 1:
            parts = np.array_split(rows, -(-len(rows) // page))
            pivots = [part[0] for part in parts]
        for part, pivot in zip(parts, pivots, strict=True):
            todo.append((part, int(pivot), node, float(distances(vectors[[pivot]], vectors[routing])[0])))
    return out


def best_of(row: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each row's ``k`` highest scores, ties to the smaller id, by row and rank."""
    order = np.lexsort((ids, -1 - score, row))
    starts = np.flatnonzero(np.diff(row[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < k]


class Tree(NamedTuple):
    """The pages of a tree, by node: parent, leaf, radius, distance to the parent, routing vector; of leaves the members' row numbers, ids and vectors."""

    parent: np.ndarray
    leaf: np.ndarray
    radius: np.ndarray
    to_parent: np.ndarray
    routing: np.ndarray
    ats: list[np.ndarray]
    ids: list[np.ndarray]
    vectors: list[np.ndarray]


def packed(key: int, ats: np.ndarray, ids: np.ndarray, held: np.ndarray, fanout: int, page: int) -> pd.DataFrame:
    """The pages of one tree as rows of PAGES."""
    rows = [(key, node, parent, leaf, radius, to_parent, held[routing].tobytes(), ats[at].tobytes(), ids[at].tobytes(), held[at].tobytes()) for node, parent, leaf, radius, to_parent, routing, at in grow(held, fanout, page)]
    return pd.DataFrame(rows, columns=[c.split()[0] for c in PAGES.split(", ")])


def unpacked(pages: pd.DataFrame, dims: int) -> Tree:
    pages = pages.sort_values("node")
    numbers = lambda column: [np.frombuffer(x, dtype=np.int64) for x in pages[column]]
    vectors = [x.reshape(-1, dims) for x in numbers("vectors")]
    return Tree(*(pages[c].to_numpy() for c in ("parent", "leaf", "radius", "to_parent")), stacked(pages["routing"], dims), numbers("ats"), numbers("ids"), vectors)


class Scale(NamedTuple):
    """Of all vectors: how many components they have, and the largest product that the sizes of components allow."""

    dims: int
    peak: float

    @property
    def exact(self) -> type:
        return np.float64 if self.peak < 2.0**52 else np.int64

    @property
    def slack(self) -> float:
        return 1e-6 + self.peak * 1e-12

    def products(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Exact inner products of all rows."""
        if self.peak >= 2.0**62 and (np.abs(a.astype(np.float64) @ b.T.astype(np.float64)) >= 2.0**63 * (1 - 1e-9)).any():
            raise OverflowError("a score has more than 64 bits")
        return (a.astype(self.exact) @ b.T.astype(self.exact)).astype(np.int64)


def norms(queries: np.ndarray) -> np.ndarray:
    return np.sqrt((queries.astype(np.float64) ** 2).sum(1)) * (1 + 1e-9)


def search(tree: Tree, scale: Scale, ats: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, vec_id, score) of the best ``k`` of one tree for each query that reach its ``floor``, the query's own row left out; and how many products it took."""
    norm, slack = norms(queries), scale.slack
    floor, taken = floor.copy(), 0
    known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    dots: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    leaves: list[tuple[int, np.ndarray, np.ndarray]] = []
    for node in range(len(tree.routing)):
        parent = int(tree.parent[node])
        if parent < 0:
            rows = np.arange(len(queries))
        elif parent in dots:
            rows, dot = dots[parent]
            rows = rows[dot + norm[rows] * (tree.to_parent[node] + tree.radius[node]) + slack >= floor[rows]]
        else:
            continue
        if not len(rows):
            continue
        dot = scale.products(queries[rows], tree.routing[node : node + 1])[:, 0].astype(np.float64)
        taken += len(rows)
        bound = dot + norm[rows] * tree.radius[node] + slack
        near = bound >= floor[rows]
        if tree.leaf[node]:
            leaves.append((node, rows[near], bound[near]))
        elif near.any():
            dots[node] = rows[near], dot[near]
    entries = [(np.full(len(rows), n), rows, bound) for n, (_, rows, bound) in enumerate(leaves)]
    which, asked, bound = (np.concatenate(x) for x in zip(*entries, strict=True)) if entries else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    order = np.lexsort((-bound, asked))
    starts = np.flatnonzero(np.diff(asked[order], prepend=-1))
    place = np.empty(len(order), int)
    place[order] = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    start, step = 0, 1
    while start <= place.max(initial=-1):
        turn = np.flatnonzero((place >= start) & (place < start + step))
        turn = turn[bound[turn] >= floor[asked[turn]]]
        turn = turn[np.argsort(which[turn], kind="stable")]
        got = [known]
        for part in np.split(turn, np.flatnonzero(np.diff(which[turn])) + 1):
            if not len(part):
                continue
            node, rows = leaves[which[part[0]]][0], asked[part]
            scores = scale.products(queries[rows], tree.vectors[node])
            taken += scores.size
            row, column = np.nonzero((scores >= floor[rows][:, None]) & (tree.ats[node][None, :] != ats[rows][:, None]))
            got.append((rows[row], tree.ids[node][column], scores[row, column]))
        row, found, score = (np.concatenate(x) for x in zip(*got, strict=True))
        best = best_of(row, found, score, k)
        known = row[best], found[best], score[best]
        held = np.bincount(known[0], minlength=len(queries))
        full = np.flatnonzero(held >= k)
        floor[full] = np.maximum(floor[full], known[2][(np.cumsum(held) - 1)[full]])
        start, step = start + step, step * 2
    return *known, taken


def pivots_of(sample: np.ndarray, wanted: int) -> np.ndarray:
    """At most ``wanted`` centres of ``sample``: rows far apart, then thrice the means of what is nearest to each."""
    chosen, nearest = [0], distances(sample, sample[0])
    while len(chosen) < wanted and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(sample, sample[chosen[-1]]))
    held = sample.astype(np.float64)
    centres = held[chosen]
    for _ in range(3):
        owner = nearest_of(held, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, held)
        some = np.bincount(owner, minlength=len(centres))
        centres = np.where(some[:, None] > 0, sums / np.maximum(some, 1)[:, None], centres)
    return centres


def nearest_of(held: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1)[None, :] - 2 * held @ centres.T).argmin(1)


def blocked(df: DataFrame, key: str, name: str, n: int) -> DataFrame:
    return df.withColumn(name, F.pmod(F.xxhash64(key), F.lit(n)))


def each(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def reached(queries: DataFrame, roots: DataFrame, sizes: tuple[int, int], scale: Scale, block: int) -> DataFrame:
    """Pairs (asked, tree, floor) whose bound reaches the query's ``floor``, but for its ``home``; where that is -1, the tree of the highest bound.

    ``sizes``: how many queries and roots there are.  They meet in blocks of both.
    """
    q_blocks, r_blocks = (max(1, -(-x // block)) for x in sizes)

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"asked": pd.Series(dtype="int64"), "tree": pd.Series(dtype="int64"), "floor": pd.Series(dtype="int64"), "bound": pd.Series(dtype="float64")})
        if not len(left) or not len(right):
            return out
        held, trees = stacked(left["raw"], scale.dims), right["tree"].to_numpy()
        bound = scale.products(held, stacked(right["routing"], scale.dims)) + norms(held)[:, None] * right["radius"].to_numpy()[None, :] + scale.slack
        home, floor = left["home"].to_numpy(), left["floor"].to_numpy()
        best = np.zeros(bound.shape, bool)
        best[np.arange(len(held)), bound.argmax(1)] = True
        row, column = np.nonzero(np.where((home < 0)[:, None], best, (bound >= floor[:, None]) & (trees[None, :] != home[:, None])))
        return pd.DataFrame({"asked": left["at"].to_numpy()[row], "tree": trees[column], "floor": floor[row], "bound": bound[row, column]})

    left = blocked(queries, "at", "q", q_blocks).withColumn("r", each(r_blocks)).groupBy("q", "r")
    right = blocked(roots, "tree", "r", r_blocks).withColumn("q", each(q_blocks)).groupBy("q", "r")
    return left.cogroup(right).applyInPandas(meet, "asked long, tree long, floor long, bound double")


def found_in(pairs: DataFrame, queries: DataFrame, index: DataFrame, scale: Scale, k: int, block: int) -> DataFrame:
    """What the queries of ``pairs`` (asked, tree, floor: a written table) find in these trees: FOUND.  A tree goes to a task for each ``block`` of its queries."""
    load = pairs.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).select("tree", F.floor((F.col("n") + block - 1) / F.lit(block)).alias("chunks"))

    def meet(pages: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(pages) or not len(asked):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("asked", "vec_id", "score")})
        ats = asked["at"].to_numpy()
        row, found, score, _ = search(unpacked(pages, scale.dims), scale, ats, stacked(asked["raw"], scale.dims), asked["floor"].to_numpy(), k)
        return pd.DataFrame({"asked": ats[row], "vec_id": found, "score": score})

    left = index.join(load, "tree").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).groupBy("tree", "chunk")
    right = pairs.join(load, "tree").withColumn("chunk", F.pmod(F.xxhash64("asked"), F.col("chunks"))).join(queries.select("at", "raw"), F.col("asked") == F.col("at")).select("tree", "chunk", "at", "raw", "floor").groupBy("tree", "chunk")
    return left.cogroup(right).applyInPandas(meet, FOUND)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, tree_rows: int = 8192, block: int = 4096, fanout: int = 16, page: int = 64, pivots: int = 1024, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each query row the ``k`` other rows with the highest integer inner products.

    Equal scores go to the smaller id.  Rows without an id, and vectors that
    are null or hold null or non-finite components, take no part; vectors of
    different lengths meet as if filled up with zeros.  Every row is a query
    (where ``is_query`` holds) and a candidate of its own, so rows that repeat
    an id find each other.  An empty table gives none; other columns are left
    out.  A score beyond 64 bits raises.  At most ``pivots`` centres, of a
    sample of about 16 times as many rows, come to the driver and go to all
    tasks; vectors move at most once into the trees, and queries to the trees
    that their bounds don't rule out.
    """
    spark = vectors.sparkSession
    wanted = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), scaled(F.col(vector), scale).alias("v"), is_query.alias("query")).where("vec_id is not null and v is not null")
    with scratch(spark):
        rows = written(wanted.withColumn("at", F.monotonically_increasing_id()), "vectors")
        n, dims, peak = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double")))))).first()
        if not n:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        sizes = Scale(max(1, dims), max(1, dims) * float(peak or 0) ** 2)
        cells = min(pivots, max(1, -(-n // tree_rows)))
        drawn = rows.where(F.pmod(F.xxhash64(F.lit(5), "at"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, 16 * cells / n))).select("v").limit(64 * cells).toPandas()
        fill = lambda v: np.pad(matrix(v), ((0, 0), (0, sizes.dims - max(map(len, v), default=0))))
        centres = pivots_of(fill(drawn["v"]), cells) if len(drawn) else np.zeros((1, sizes.dims))

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    held = fill(pdf["v"])
                    yield pdf[["at", "vec_id", "query"]].assign(cell=nearest_of(held.astype(np.float64), centres), raw=[x.tobytes() for x in held])

        placed = written(rows.mapInPandas(place, "at long, vec_id long, query boolean, cell long, raw binary"), "placed")
        parts = {r["cell"]: max(1, -(-r["n"] // tree_rows)) for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
        several = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])[F.col("cell")]

        def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            return packed(key[0], pdf["at"].to_numpy(), pdf["vec_id"].to_numpy(), stacked(pdf["raw"], sizes.dims), fanout, page)

        tree = F.col("cell") * (1 << 32) + F.pmod(F.xxhash64("at"), several)
        index = written(placed.withColumn("tree", tree).groupBy("tree").applyInPandas(build, PAGES), "mtree")
        roots = index.where("parent < 0").select("tree", "radius", "routing")
        queries = placed.where("query").select("at", "vec_id", "raw")
        n_pairs = queries.count(), sum(parts.values())
        first = reached(queries.withColumns({"home": F.lit(-1).cast("long"), "floor": F.lit(LOWEST).cast("long")}), roots, n_pairs, sizes, block)
        homes = written(first.groupBy("asked").agg(F.max_by("tree", "bound").alias("tree"), F.first("floor").alias("floor")), "homes")
        at_home = written(found_in(homes, queries, index, sizes, k, block), "at_home")
        floors = at_home.groupBy("asked").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
        again = queries.join(homes.select(F.col("asked").alias("at"), F.col("tree").alias("home")), "at").join(floors.withColumnRenamed("asked", "at"), "at", "left").withColumn("floor", F.coalesce("floor", F.lit(LOWEST)))
        pairs = written(reached(again, roots, n_pairs, sizes, block).drop("bound"), "pairs")
        found = at_home.unionByName(found_in(pairs, queries, index, sizes, k, block))
        by_score = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
        best = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
        out = best.join(queries.select(F.col("at").alias("asked"), F.col("vec_id").alias("query_id")), "asked")
        return written(out.select("query_id", "rank", "vec_id", "score"), "nearest", keep=True)
