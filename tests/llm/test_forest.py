"""MinHash forest against brute force on full sets."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from quillon.llm import forest
from quillon.llm.jaccard import shingle_sets

from .conftest import prose

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text, size=3):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    return frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def brute(rows, percent=85):
    """(doc_id, n_shingles, component_id, kept) from all pairs."""
    sets, up = [shingles(t) for _, t in rows], list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                up[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    of = [least.get(top(k), i) if sets[k] else i for k, (i, _) in enumerate(rows)]
    return Counter((i, len(sets[k]), of[k], i == of[k]) for k, (i, _) in enumerate(rows))


def found(frame, **options):
    return Counter(map(tuple, forest.near_duplicates(frame, **options).collect()))


def chains(groups=5, copies=12):
    """Near copies whose ends don't link, and copies just below the threshold."""
    rng, rows = random.Random(4), []
    for group in range(groups):
        words = prose(100 + group, 80 + 40 * group).split()
        for k in range(copies):
            rows.append((group * 100 + k, " ".join(words)))
            for _ in range(rng.choice([1, 1, 2, 4])):
                words[rng.randrange(len(words))] = f"w{rng.random()}"
    return rows


def test_odd_rows(odd, odd_rows):
    assert found(odd) == brute(odd_rows)
    assert found(odd.limit(0)) == Counter()


def test_hot_copies_and_a_common_passage(spark):
    """A third of all rows are one text, another third hold one passage beside their own words."""
    common = prose(5, 60)
    rows = [(k, prose(6, 100)) for k in range(60)] + [(100 + k, f"{common} {prose(200 + k, 90)}") for k in range(60)] + [(300 + k, prose(400 + k, 70)) for k in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(frame) == brute(rows)


@pytest.mark.parametrize("options", [{}, {"block": 4}, {"block": 1}, {"block": 2, "depth": 3}], ids=str)
def test_chains(spark, options):
    """Links are the same in blocks, after deeper prefixes and in products of large regions."""
    rows = chains()
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), **options) == brute(rows)


def test_groups_of_near_copies_are_no_pairs(spark, monkeypatch):
    """Regions of 40 sets that don't link, once in each tree: 780 pairs, of which none is joined."""
    rows = [(k, 20, k) for k in range(40)] + [(100 + k, 20, 7) for k in range(40)] + [(k, 20, k) for k in range(3)]
    rows = [(region, *r) for region in (1, 2) for r in rows[:40]] + [(3, *r) for r in rows[40:80]] + [(4, *r) for r in rows[80:]]
    groups = forest.blocks(spark.createDataFrame(rows, "region long, cid long, n long, component long")).collect()
    assert sorted((r["m"], [o["cid"] for o in r["others"]]) for r in groups) == [(3, [0, 1, 2]), (40, list(range(40)))]
    joined, confirmed = [], forest.confirmed
    monkeypatch.setattr(forest, "confirmed", lambda pairs, sets, percent: joined.append(pairs.count()) or confirmed(pairs, sets, percent))
    own = [(k, f"{prose(5, 60)} {prose(200 + k, 20)}") for k in range(40)]
    assert found(spark.createDataFrame(own, "doc_id long, text string").repartition(3)) == brute(own)
    assert joined[-1] <= (forest.FEW - 1) / 2 * forest.TREES * len(own) and joined[-1] < 780


def test_signatures_agree_as_often_as_sets_do(spark):
    """Over many min-hashes the share of equal ones is the Jaccard similarity; copies in one batch of many rows or alone have the same."""
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    for shared in (200, 1000, 1800):
        a, b = pool[:1900], np.concatenate([pool[1900 - shared : 1900], pool[1900 : 3800 - shared]])
        sigs = forest.signatures(np.concatenate([a, b]), np.array([0, len(a)]), 64, 16)
        want = shared / (len(a) + len(b) - shared)
        assert abs((sigs[0] == sigs[1]).mean() - want) < 5 * (want * (1 - want) / 1024) ** 0.5
        assert (forest.signatures(b, np.array([0]), 64, 16)[0] == sigs[1]).all()


def test_sorted_orders_keep_all_long_prefixes(spark):
    """Of every tree, at least the sets that share a prefix with another; slices of any size sign alike."""
    rows = chains(3, 8) + [(900 + k, prose(900 + k, 50)) for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    grams = shingle_sets(frame, 3, "doc_id", "text", None, 85)
    sets = forest.signed(grams, 4, 6).selectExpr("doc_id as cid", "n", "sig")
    assert {tuple(r) for r in sets.collect()} == {tuple(r) for r in forest.signed(grams, 4, 6, at_most=100).selectExpr("doc_id as cid", "n", "sig").collect()}
    prefixes = Counter((tree, r["sig"][tree * 12 : tree * 12 + 6]) for r in sets.collect() for tree in range(4))
    kept = Counter((r["tree"], bytes(r["sig"][:6])) for r in forest.neighbours(sets, 4, 6, 3).collect())
    assert all(kept[p] == n for p, n in prefixes.items() if n > 1)
    assert sum(kept.values()) < len(rows) * 4


def test_long_texts(spark):
    text = prose(77, 800_000)
    assert len(text.encode()) > 4_000_000
    words = text.split()
    words[::400] = ["another"] * len(words[::400])
    rows = [(1, text), (2, " ".join(words)), (3, " " * 5_000_000), (4, "x" * 5_000_000), (5, "same word " * 500_000), (6, prose(78, 40)), (7, None)]
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, True), 2: (1, False), **{k: (k, True) for k in (3, 4, 5, 6, 7)}}
