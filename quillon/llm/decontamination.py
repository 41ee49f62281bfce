"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are sequences of words (letters and digits,
lower-cased).  Runs of ``least`` words that both have are the seeds; they are
joined by hash, against blocks of the benchmark of bounded size.  Where an
item's seeds could cover enough of it, running Karp-Rabin greedy tiling marks
the longest common run that isn't marked yet, again and again down to ``least``
words.  Tiles may stand in any order, so a passage whose parts were moved is
covered as well; a document is contaminated where the tiles cover enough of an
item.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .words import PUNCTUATION, STEP, mixed, slices


class Block(NamedTuple):
    """Benchmark items: ids and word hashes; sorted seeds with the items and places that have them."""

    ids: list
    items: list[np.ndarray]
    seeds: np.ndarray
    owner: np.ndarray
    place: np.ndarray


def rolling(tokens: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` tokens."""
    n = len(tokens) - size + 1
    h = np.zeros(max(0, n), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size if n > 0 else 0):
            h = h * STEP + tokens[k : k + n]
        return mixed(h)


class Rolling:
    """Karp-Rabin hashes of all runs of a sequence's tokens, of any length, from one pass."""

    def __init__(self, tokens: np.ndarray) -> None:
        n = len(tokens)
        with np.errstate(over="ignore"):
            up, self.down = (np.append(np.uint64(1), np.full(n, x, np.uint64)).cumprod(dtype=np.uint64) for x in (int(STEP), pow(int(STEP), -1, 1 << 64)))
            self.sums = np.append(np.uint64(0), np.cumsum(tokens * up[:n], dtype=np.uint64))

    def runs(self, at: np.ndarray, size: int) -> np.ndarray:
        """The hashes of the runs of ``size`` tokens from places ``at`` on."""
        with np.errstate(over="ignore"):
            return (self.sums[at + size] - self.sums[at]) * self.down[at]


def free_runs(free: np.ndarray) -> np.ndarray:
    """For each place, how many free ones there are from it on without a gap."""
    n = len(free)
    taken = np.where(free, n, np.arange(n))
    return np.minimum.accumulate(taken[::-1])[::-1] - np.arange(n)


def tiles(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(place in item, place in text, length) of the greedy tiling by runs of at least ``least`` equal tokens.

    Each round finds the greatest length of which both have an unmarked run in
    common, by running Karp-Rabin hashes and halving the bounds of the length
    (a run's parts are common, too), and marks its matches from the first place
    in the item on, each at the first place in the text that is free.  A run's
    places are walked once a round, so repeated words take no pairs of places.
    """
    free_a, free_b, out = np.ones(len(item), bool), np.ones(len(text), bool), []
    hash_a, hash_b = Rolling(item), Rolling(text)

    def common(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        at_a, at_b = np.flatnonzero(run_a >= size), np.flatnonzero(run_b >= size)
        a, b = hash_a.runs(at_a, size), hash_b.runs(at_b, size)
        both = np.isin(b, a)
        return at_a, a, at_b[both], b[both]

    high = min(len(item), len(text))
    while True:
        run_a, run_b = free_runs(free_a), free_runs(free_b)
        low, high = least - 1, min(high, int(run_a.max(initial=0)), int(run_b.max(initial=0)))
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if len(common(middle)[3]) else (low, middle - 1)
        if low < least:
            return out
        at_a, a, at_b, b = common(low)
        order = np.argsort(b, kind="stable")
        at_b, b = at_b[order], b[order]
        places, ends = np.searchsorted(b, a, "left"), np.searchsorted(b, a, "right")
        next_of: dict[int, int] = {}
        end_a = marked = 0
        for k in np.flatnonzero(ends > places):
            start = int(at_a[k])
            if start < end_a:
                continue
            at = next_of.get(int(a[k]), int(places[k]))
            while at < ends[k]:
                to = int(at_b[at])
                if free_b[to : to + low].all() and (item[start : start + low] == text[to : to + low]).all():
                    break
                at += 1
            next_of[int(a[k])] = at
            if at < ends[k]:
                free_a[start : start + low] = free_b[to : to + low] = False
                out.append((start, to, low))
                end_a, marked = start + low, marked + 1
        high = low if marked else low - 1


def blocks(benchmark: DataFrame, least: int, held: int) -> Iterator[Block]:
    """The benchmark (item_id, text) in blocks of about ``held`` words, read one after the other; items without a word are left out."""
    ids: list = []
    items: list[np.ndarray] = []
    size = 0

    def block() -> Block:
        hashes = [rolling(t, least if len(t) >= least else len(t)) for t in items]
        owner = np.repeat(np.arange(len(items)), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes])
        seeds = np.concatenate(hashes)
        order = np.argsort(seeds, kind="stable")
        return Block(ids, items, seeds[order], owner[order], place[order])

    for row in benchmark.select("item_id", "text").where("text is not null").orderBy("item_id", "text").toLocalIterator():
        for _, w, _, _ in slices(pa.array([row["text"]]), between=PUNCTUATION):
            if len(w.hash):
                ids.append(row["item_id"])
                items.append(w.hash)
                size += len(w.hash)
        if size >= held:
            yield block()
            ids, items, size = [], [], 0
    if items:
        yield block()


def covered(block: Block, tokens: np.ndarray, seed_hits: np.ndarray, least: int, coverage: float) -> list[tuple[int, int]]:
    """(item, covered words) of the items that the tiles in ``tokens`` cover by ``coverage``; ``seed_hits``: places of runs that the block has."""
    seeds, which = np.unique(rolling(tokens, least)[seed_hits], return_inverse=True)
    low, high = np.searchsorted(block.seeds, seeds, "left"), np.searchsorted(block.seeds, seeds, "right")
    at = np.concatenate([np.arange(a, b) for a, b in zip(low, high, strict=True)]) if len(seeds) else np.zeros(0, int)
    seed = np.repeat(np.arange(len(seeds)), high - low)
    order = np.argsort(block.owner[at], kind="stable")
    owners, first = np.unique(block.owner[at][order], return_index=True)
    out = []
    for one, mine in zip(owners, np.split(order, first[1:]), strict=True):
        item = block.items[one]
        within = np.zeros(len(item) + 1, int)
        np.add.at(within, block.place[at[mine]], 1)
        np.add.at(within, block.place[at[mine]] + least, -1)
        if (np.cumsum(within[:-1]) > 0).sum() < coverage * len(item):
            continue
        his = np.zeros(len(seeds), bool)
        his[seed[mine]] = True
        near = np.zeros(len(tokens) + 1, int)
        np.add.at(near, seed_hits[his[which]], 1)
        np.add.at(near, seed_hits[his[which]] + least, -1)
        near = np.cumsum(near[:-1]) > 0
        # Seed runs of the text, apart by a token that no item has.
        apart = np.append(False, near[:-1]) & ~near
        parts = np.where(apart, np.uint64(0), tokens)[near | apart]
        n = sum(t[2] for t in tiles(item, parts, least))
        if n >= coverage * len(item):
            out.append((int(one), n))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = 5, coverage: float = 0.6, held: int = 1 << 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, item_id, item_words, covered_words and coverage of every document and item that its tiles cover by ``coverage``.

    Items shorter than ``least`` words count where they stand whole.  Null and
    empty texts and items give nothing; repeated rows are reported once each;
    texts of any length are read whole; other columns are left out; an empty
    benchmark gives an empty table.  The benchmark is broadcast in blocks of at
    most about ``held`` words and one item more; a larger one takes a pass over
    the documents for each block.
    """
    spark = docs.sparkSession
    doc_type, item_type = docs.schema[doc_id].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    batch_item = to_arrow_type(benchmark.schema["item_id"].dataType)
    schema = f"doc_id {doc_type}, item_id {item_type}, item_words int, covered_words int"
    out = None
    for block in blocks(benchmark, least, held):
        shared = spark.sparkContext.broadcast(block)

        def match(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            sizes = sorted({min(least, len(t)) for t in block.items})
            for batch in batches:
                rows, items, words, held_words = [], [], [], []
                for first, w, _, _ in slices(batch.column(1), between=PUNCTUATION):
                    for size in sizes:
                        h = rolling(w.hash, size)
                        at = np.minimum(np.searchsorted(block.seeds, h), len(block.seeds) - 1)
                        hits = np.flatnonzero((block.seeds[at] == h) & (w.row[: len(h)] == w.row[size - 1 :][: len(h)]))
                        for row in np.unique(w.row[hits]):
                            a, b = np.searchsorted(w.row, [row, row + 1])
                            mine = hits[(hits >= a) & (hits < b)] - a
                            for item, n in covered(block, w.hash[a:b], mine, size, coverage):
                                if min(least, len(block.items[item])) == size:
                                    rows.append(first + int(row))
                                    items.append(block.ids[item])
                                    words.append(len(block.items[item]))
                                    held_words.append(n)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int32())), pa.array(items, batch_item), pa.array(words, pa.int32()), pa.array(held_words, pa.int32())], names=["doc_id", "item_id", "item_words", "covered_words"])

        part = docs.select(doc_id, text).mapInArrow(match, schema)
        out = part if out is None else out.unionByName(part)
    out = spark.createDataFrame([], schema) if out is None else out
    return out.withColumn("coverage", F.round(F.col("covered_words") / F.col("item_words"), 6))
