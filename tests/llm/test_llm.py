"""The corpus operators against brute force, on small and odd tables."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.llm import bits, decontamination, hot, jaccard, language_id, metric_search, packing, sharding, substrings, toxicity, url_filter, warc
from quillon.llm.components import components
from quillon.llm.queries import ORACLE_SQL, QUERIES, RULES, tokenizer

from .conftest import prose

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


# --- 4, n-gram Jaccard join


def shingle_set(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                up[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return Counter((i, len(sets[k]), least.get(top(k), i) if sets[k] else i) for k, (i, _) in enumerate(rows))


def test_jaccard_equals_brute_force(odd, odd_rows):
    got = jaccard.jaccard_components(odd)
    assert Counter(map(tuple, got.collect())) == brute_components(odd_rows)


def test_jaccard_chains_and_blocks(spark):
    """Chains of near copies whose ends don't link, in blocks of four rows."""
    rng, rows = random.Random(4), []
    for group in range(6):
        words = prose(100 + group, 60 + 40 * group).split()
        for k in range(12):
            rows.append((group * 100 + k, " ".join(words)))
            words[rng.randrange(len(words))] = f"w{rng.random()}"
    rows += [(900 + k, "the same line " * 4 + prose(300 + k, 8)) for k in range(15)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, jaccard.jaccard_components(frame, block=4).collect())) == brute_components(rows)
    assert jaccard.jaccard_components(frame.limit(0)).count() == 0


def test_passages_in_common_deal_no_whole_sets(spark, monkeypatch):
    """Texts of three passages, each in two texts: all hang together, none link, and no whole set is made for them; the few that link are found."""
    made, orig = {}, jaccard.written

    def written(df, name, *rest, **more):
        out = orig(df, name, *rest, **more)
        made[name] = out.count()
        return out

    monkeypatch.setattr(jaccard, "written", written)
    rng = random.Random(9)
    owners = [k // 2 for k in range(3 * 120)]
    rng.shuffle(owners)
    rows = [(k, " ".join(prose(5000 + p, 40) for p in owners[3 * k : 3 * k + 3])) for k in range(120)]
    copies = [(1000 + k, rows[k][1] + " and one more") for k in range(4)]
    frame = spark.createDataFrame(rows + copies, "doc_id long, text string")
    got = Counter(map(tuple, jaccard.jaccard_components(frame, block=4).collect()))
    assert got == brute_components(rows + copies) and made["pairs"] > 100 and made["full"] <= 16


def test_blocks_are_dealt_in_passes(spark, odd, odd_rows, monkeypatch):
    """A dense cluster without links of its hub's, in blocks of two rows and passes of one fold: each pass is a written table."""
    made, orig = Counter(), jaccard.written

    def written(df, name, *rest, **more):
        made[name] += 1
        return orig(df, name, *rest, **more)

    monkeypatch.setattr(jaccard, "written", written)
    monkeypatch.setattr(jaccard, "DEALT", 1)
    monkeypatch.setattr(jaccard, "FOLD", 1)
    core = prose(77, 60)
    rows = [(k, f"{core} {prose(6000 + k // 2, 18)}" + " x" * (k % 2)) for k in range(24)] + [r for r in odd_rows if r[0] is not None]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, jaccard.jaccard_components(frame, block=2).collect())) == brute_components(rows) and made["blocks"] > 2


def test_structured_words_have_hashes_of_their_own(spark):
    """Words of two letters whose polynomial hashes modulo 2^64 are equal for every odd base."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, other), (3, f"{word} x y z w {other}"), (4, f"{other} x y z w {word}"), (5, "abcdefgh"), (6, "abcdefgi"), (7, "ABCDEFGH")]
    assert Counter(map(tuple, jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())) == brute_components(rows)


def test_classes_whose_ids_clash_stay_apart(spark, odd_rows):
    """Ids of 9 bits for some 65 classes: several clash at first."""
    rows = [(100 + k, prose(400 + k // 2, 30)) for k in range(110)] + [r for r in odd_rows if r[0] is not None]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sets = jaccard.written(jaccard.shingle_sets(frame, 5, "doc_id", "text", 20, 80).where("n > 0"), "sets")
    classes, _ = jaccard.class_ids(sets, 9)
    got = classes.collect()
    assert len({r["cid"] for r in got}) == len(got) == sets.select("n", "s1", "s2").distinct().count() and max(r["cid"] for r in got) < 512 and sets.select(F.pmod(F.xxhash64(F.lit(0), "n", "s1", "s2"), F.lit(512)).alias("b"), "n", "s1", "s2").distinct().select("b").distinct().count() < len(got)
    assert Counter(map(tuple, jaccard._components(frame, 80, 5, 1024, "doc_id", "text", bits=9).collect())) == brute_components(rows)


def test_hot_shingles_are_dealt_without_loss(spark, odd, odd_rows, monkeypatch):
    monkeypatch.setattr(jaccard, "hot_keys", lambda sample, key, tasks: [r[key] for r in jaccard.shingle_sets(odd, 5, "doc_id", "text", None, 80).select(F.explode("grams").alias(key)).distinct().limit(500).collect()])
    assert Counter(map(tuple, jaccard.jaccard_components(odd).collect())) == brute_components(odd_rows)


def test_hot_keys_are_few(spark):
    sample = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).cast("long").alias("k"))
    assert hot.hot_keys(sample, "k", 4) == [7] and hot.hot_keys(sample.limit(0), "k", 4) == []


def test_bit_tables_let_all_keys_pass(spark):
    keys = jaccard.written(spark.range(0, 3000, 3).withColumnRenamed("id", "k"), "keys")
    rows = spark.range(3000).select(F.when(F.col("id") != 5, F.col("id")).alias("k"), F.lit("x").alias("at"))
    assert {r["k"] for r in bits.without_keys(rows, keys, "k").collect()} == {None, *(k for k in range(3000) if k % 3 and k != 5)}
    assert bits.bits_for(10**9) == 0 and bits.bits_for(0) == 1 << 16 and bits.bits_for(10**6) == 1 << 24


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(0, 40)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100}


def test_components_take_no_more_tasks_than_their_links_need(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(0, 40)] + [(k, 100 + k % 3) for k in range(200, 260)], "a long, b long").coalesce(1)
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    context, group = spark.sparkContext, "components of few links"
    for k, v in settings.items():
        spark.conf.set(k, v)
    context.setJobGroup(group, group)
    try:
        got = components(links, rows=100)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    told = context.statusTracker()
    stages = [told.getStageInfo(s) for job in told.getJobIdsForGroup(group) for s in told.getJobInfo(job).stageIds]
    assert stages and max(s.numTasks for s in stages if s) <= 8
    assert {r["node"]: r["component"] for r in got.collect()} == {k: 0 for k in range(41)} | {k: 100 + k % 3 for k in range(200, 260)} | {k: k for k in (100, 101, 102)}


# --- 10, substring dedup


def brute_dedup(rows, least_words=24, least_bytes=600):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    first, out = {}, {}
    for k in order:
        raw, spans = (rows[k][1] or "").encode(), []
        ends = [0, *substrings.chunk_ends(np.frombuffer(raw, np.uint8)).tolist()]
        sizes = np.diff(ends)
        # Words that begin in each chunk.
        words = np.array([sum(1 for x in range(a, b) if raw[x : x + 1].strip() and (x == 0 or not raw[x - 1 : x].strip())) for a, b in zip(ends, ends[1:])], int)
        for i in range(len(sizes)):
            for j in range(i + 1, len(sizes) + 1):
                enough = lambda a, b: words[a:b].sum() >= least_words or sizes[a:b].sum() >= least_bytes
                if enough(i, j):
                    # the shortest run from i on, and those that end here without a shorter one from a later chunk
                    if first.setdefault(raw[ends[i] : ends[j]], k) != k:
                        spans.append(ends[i] << 32 | ends[j] - ends[i])
                    break
        for j in range(1, len(sizes) + 1):
            i = next((i for i in range(j - 1, -1, -1) if words[i:j].sum() >= least_words or sizes[i:j].sum() >= least_bytes), None)
            if i is not None and first.setdefault(raw[ends[i] : ends[j]], k) != k:
                spans.append(ends[i] << 32 | ends[j] - ends[i])
        out[k] = (rows[k][0], substrings.without(rows[k][1], substrings.merged(np.array(spans))) if spans else rows[k][1])
    return Counter(out.values())


def test_substring_dedup_equals_brute_force(odd, odd_rows):
    got = substrings.dedup_substrings(odd)
    assert got.columns == ["doc_id", "text", "lang", "source", "n", "shard", "spans"]
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == brute_dedup(odd_rows)
    assert substrings.dedup_substrings(odd.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [False, True])
def test_hot_chunks_are_dealt_without_loss(spark, hot, monkeypatch):
    """Every digest is taken as hot: its groups' first rows still give one first row of all."""
    passage = prose(51, 60)
    rows = [(k % 40, f"{prose(70 + k, 5)} {passage} {prose(170 + k, 6)}") for k in range(60)] + [(None, passage), (3, passage)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    if hot:
        monkeypatch.setattr(substrings, "hot_keys", lambda sample, key, tasks: [r[key] for r in substrings.windowed(substrings.numbered(frame), "doc_id", "text", 24, 600).select("digest").distinct().collect()])
    got = Counter((r["doc_id"], r["text"]) for r in substrings.dedup_substrings(frame).collect())
    firsts = [t for i, t in got if i == 0 and t in {x for j, x in rows if j == 0}]
    assert len(firsts) == 1 and sum(n for (_, t), n in got.items() if t and passage in t) == 1
    assert sum(got.values()) == len(rows)


def test_passages_are_cut_wherever_they_stand(spark):
    passage = prose(50, 60)
    rows = [(k, f"{prose(60 + k, 10 + 3 * k)} {passage} {prose(90 + k, 20)}") for k in range(12)]
    got = {r["doc_id"]: r for r in substrings.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0]["spans"] is None and got[0]["text"] == rows[0][1]
    assert all(len(got[k]["spans"]) == 1 and len(got[k]["text"].split()) < 60 + 10 + 3 * k for k in range(1, 12))


def test_short_chunks_of_many_texts_make_no_passage(spark):
    """Every chunk of text 1000, with its neighbour, stands in an earlier text, but no 24 words of it stand together there; only passages that do go."""
    passage, text = prose(51, 60), prose(111, 120)
    raw = text.encode()
    ends = substrings.chunk_ends(np.frombuffer(raw, np.uint8)).tolist()
    chunks = [raw[a:b].decode() for a, b in zip([0, *ends], ends)]
    pairs = ["".join(chunks[k : k + 2]) for k in range(len(chunks) - 1)]
    assert all(len(x.split()) < 24 for x in pairs)
    rows = [(k, f"{prose(5000 + k, 12)} {x}{prose(6000 + k, 12)}") for k, x in enumerate(pairs)]
    rows += [(1000, text), (1001, passage), (1002, f"{prose(53, 30)} {passage}"), (1003, passage)]
    got = {r["doc_id"]: r["text"] for r in substrings.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == t for i, t in rows if i < 1002)
    assert got[1003] == "" and len(got[1002].split()) < 45


def test_windows_cover_a_run_up_to_its_edges():
    rng = random.Random(8)
    for _ in range(200):
        words = np.array([rng.choice([0, 1, 1, 2, 5, 9, 30]) for _ in range(rng.randint(1, 30))])
        first, after = substrings.windows(5 * words + 1, words, 24, 600)
        assert all(words[a:b].sum() >= 24 for a, b in zip(first, after))
        for a in range(len(words)):
            for b in range(a + 1, len(words) + 1):
                held = [(x, y) for x, y in zip(first.tolist(), after.tolist()) if a <= x and y <= b]
                assert set().union(*(range(x, y) for x, y in held)) == (set(range(a, b)) if words[a:b].sum() >= 24 else set())


def test_gear_hash_is_the_rolling_one():
    data = np.frombuffer(prose(9, 50).encode(), np.uint8)
    h, want = 0, []
    for b in data:
        h = (2 * h + int(substrings.GEAR[b])) & 0xFFFF
        want.append(h)
    assert substrings.gear_hash(data).tolist() == want


# --- 1, decontamination


def test_tiles_are_greedy():
    a, b = np.array([1, 2, 3, 4, 5, 6, 7, 8, 9], np.uint64), np.array([6, 7, 8, 9, 50, 1, 2, 3, 4, 5, 60, 1, 2, 3], np.uint64)
    assert sorted(decontamination.tiles(a, b, 3)) == [(0, 5, 5), (5, 0, 4)]
    assert decontamination.tiles(a, b, 6) == []


def greedy_tiles(a, b, least):
    """Greedy string tiling by its definition: the longest common run of unmarked tokens, the first in the item and then in the text, again and again."""
    free_a, free_b, out = [True] * len(a), [True] * len(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and free_a[i + n] and free_b[j + n] and a[i + n] == b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return out
        out.append((i, j, n))
        free_a[i : i + n] = free_b[j : j + n] = [False] * n


def test_tiles_equal_the_definition():
    rng = random.Random(12)
    for _ in range(150):
        kinds = rng.choice([1, 2, 3, 6, 20])
        a, b = ([rng.randint(1, kinds) for _ in range(rng.randint(1, n))] for n in (25, 40))
        assert sorted(decontamination.tiles(np.array(a, np.uint64), np.array(b, np.uint64), 3)) == sorted(greedy_tiles(a, b, 3))
    same = np.full(1_000_000, 7, np.uint64)
    assert decontamination.tiles(same[:200], same, 5) == [(0, 0, 200)]


def test_contamination_equals_the_definition(spark):
    """Documents made of parts of items, in any order and with repeats, against tilings by definition."""
    rng = random.Random(13)
    items = [(f"i{k}", prose(600 + k, 25)) for k in range(6)] + [("w", "same " * 12)]
    docs = []
    for k in range(40):
        parts = []
        for _ in range(rng.randint(1, 5)):
            words = rng.choice(items)[1].split()
            a = rng.randrange(len(words))
            parts.append(" ".join(words[a : a + rng.randint(3, 20)]) if rng.random() < 0.8 else prose(rng.randrange(9999), 9))
        docs.append((k, " ".join(parts)))
    plain = lambda t: re.findall(r"[a-z0-9]+", t.lower())
    want = set()
    for i, t in docs:
        for j, x in items:
            n = sum(k for *_, k in greedy_tiles(plain(x), plain(t), 5))
            if n >= 0.6 * len(plain(x)):
                want.add((i, j, len(plain(x)), n))
    got = decontamination.contaminated(spark.createDataFrame([(i, t, "more", 1) for i, t in docs], "doc_id long, text string, item_id string, coverage int"), spark.createDataFrame([(j, x, 1) for j, x in items], "item_id string, text string, doc_id int"))
    assert {tuple(r)[:4] for r in got.collect()} == want and want


def test_reordered_passages_are_caught(spark):
    items = [(k, prose(200 + k, 40)) for k in range(5)] + [(9, None), (10, ""), (11, "tiny item")]
    first, second = items[0][1].split(), items[1][1].split()
    docs = [
        (0, f"{prose(1, 30)} {items[0][1].upper()}! {prose(2, 30)}"), (1, " ".join(second[20:] + prose(3, 10).split() + second[:20])), (2, " ".join(first[:15]) + " " + prose(4, 60)), (3, prose(5, 500)),
        (4, None), (5, ""), (6, "a tiny, item here"), (7, items[2][1]), (7, items[2][1]),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = [(0, 0, 40, 40), (1, 1, 40, 40), (6, 11, 2, 2), (7, 2, 40, 40), (7, 2, 40, 40)]
    for held in (1 << 20, 50):
        got = decontamination.contaminated(frame, bench, held=held)
        assert sorted(tuple(r)[:4] for r in got.collect()) == want
    assert decontamination.contaminated(frame, bench.limit(0)).count() == 0
    assert decontamination.contaminated(frame.limit(0), bench).count() == 0


# --- 2, packing


def test_packing(odd, odd_rows):
    from tokenizers import Tokenizer
    import public_tokenizers

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, t in odd_rows:
        ids = np.array(model.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        for piece, (start, n) in enumerate(packing.piece_bounds(len(ids), 1024)):
            want[i, piece, start, n, zlib.crc32(ids[start : start + n].tobytes())] += 1
    got = packing.pack_documents(odd.select("doc_id", "text"), *tokenizer()).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in got)
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        held.sort()
        assert [o for o, _ in held] == np.cumsum([0] + [n for _, n in held])[:-1].tolist() and sum(n for _, n in held) <= 1024


def test_packed_sequences_hold_their_tokens(spark, odd, odd_rows, tmp_path, monkeypatch):
    import corpus_pipeline
    from quillon.llm import queries

    seen, bpe = [], packing.encoder(*tokenizer())
    monkeypatch.setattr(queries, "pack_documents", lambda *a, **k: seen.append(packing.pack_documents(*a, **k)) or seen[-1])
    odd.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(map(tuple, QUERIES["op2_best_fit_packing"](spark, str(tmp_path)).collect()))
    columns = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    want = Counter()
    for i, t in odd_rows:
        want[i, np.array([*bpe.encode_ordinary(t or ""), 2], "<u4").tobytes()] += 1
    for rows in (seen[0].collect(), corpus_pipeline.pack_sequences(spark, odd, str(tmp_path)).collect()):
        pieces = {}
        for r in rows:
            pieces.setdefault((r["doc_id"], r["piece"]), []).append(bytes(r["ids"]))
        assert all(len(r["ids"]) == 4 * r["length"] for r in rows)
        # only 11 repeats, with one piece of one text
        texts = Counter((i, ids) for (i, p), held in pieces.items() if p == 0 for ids in (b"".join([x, *(pieces[i, k][0] for k in range(1, 99) if (i, k) in pieces)]) for x in held))
        assert texts == want
    assert Counter(tuple(zlib.crc32(r["ids"]) if c == "ids_crc32" else r[c] for c in columns) for r in seen[0].collect()) == got


def test_tokens_of_special_strings_equal_the_tokenizers():
    from tokenizers import Tokenizer
    import public_tokenizers

    model, bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.encoder(*tokenizer())
    runs = ["x" + " " * 5000 + "y", "x" + "\n" * 4096 + "'s", "\u3000\xa0 " * 3000, " " * 4097 + "<|endoftext|>" + "\t" * 9000 + "<|endoftext|> ", ("a" + " " * 4500) * 3, "\x1c" * 5000, " " * 3_000_000, "\n" * 1_500_000 + " z"]
    for text in (*runs, "a <|endoftext|> b", "tabs\t\t\n\n  x", "naïve 😀 日本", "don't  stop   \n"):
        assert packing.encoded(bpe, text) == model.encode(text, add_special_tokens=False).ids


def test_best_fit_is_that_of_single_pieces():
    rng = random.Random(6)
    for _ in range(30):
        sizes = [rng.randint(1, 64) for _ in range(rng.randint(1, 300))]
        runs = packing.best_fit_runs(Counter(sizes), 64)
        bins = {}
        for size, n in Counter(sizes).items():
            for rank in range(n):
                at, first, offset = max(r for r in runs[size] if r[0] <= rank)
                bins.setdefault(first + rank - at, []).append((offset, size))
        gaps = []
        for size in sorted(sizes, reverse=True):
            fit = min((g for g in gaps if g >= size), default=None)
            if fit is None:
                gaps.append(64 - size)
            else:
                gaps[gaps.index(fit)] = fit - size
        assert len(bins) == len(gaps)
        for held in bins.values():
            held.sort()
            assert [o for o, _ in held] == np.cumsum([0] + [n for _, n in held])[:-1].tolist() and sum(n for _, n in held) <= 64
    assert packing.best_fit_runs({}, 64) == {}


# --- 8, sharding


def test_shards_are_a_shuffle_of_the_buckets(spark):
    """Each bucket's rows fill its own places in the whole order, the buckets one after the other, and orders differ by seed."""
    rows = spark.range(1000).select(F.col("id").alias("doc_id"))
    orders = []
    for seed in (7, 8):
        got = sharding.shuffle_shards(rows, 6, seed=seed, bucket_rows=100).withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(10))).collect()
        order = sorted(got, key=lambda r: r["slot"] * 6 + r["shard"])
        assert [r["slot"] * 6 + r["shard"] for r in order] == list(range(1000))
        assert [r["bucket"] for r in order] == sorted(r["bucket"] for r in order)
        orders.append([r["doc_id"] for r in order])
        inner = [r["doc_id"] for r in order if r["bucket"] == 0]
        assert inner != sorted(inner)
    assert orders[0] != orders[1]


@pytest.mark.parametrize("bucket_rows", [4, 1 << 16])
def test_shards(spark, odd, bucket_rows):
    rows = odd.unionByName(odd).drop("shard")
    got = sharding.shuffle_shards(rows, 5, bucket_rows=bucket_rows).collect()
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert len(got) == rows.count() and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())
    assert sharding.shuffle_shards(rows.limit(0), 5).count() == 0
    same = sharding.shuffle_shards(spark.range(40).select(F.lit(1).alias("x")), 3, bucket_rows=2)
    assert same.select("shard", "slot").distinct().count() == 40


def test_shards_hold_whole_texts(spark, odd, odd_rows, tmp_path, monkeypatch):
    from quillon.llm import queries

    odd.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "new_path", lambda _, name: f"{tmp_path}/{name}")
    got = QUERIES["op8_shuffle_shards"](spark, str(tmp_path)).collect()
    rows = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in odd_rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == rows
    held = spark.read.parquet(f"{tmp_path}/shards").collect()
    assert Counter((r["doc_id"], r["text"]) for r in held) == Counter(odd_rows)
    assert {(r["shard"], r["slot"]) for r in held} == {(r["shard"], r["slot"]) for r in got} and len(got) == len({(r["shard"], r["slot"]) for r in got})


# --- 7, search


def nearest(vectors, k, queries, scale=64):
    """(query id, rank, id, score) by all products; rows of one id are rows of their own."""
    whole = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for a, (i, q) in enumerate(whole):
        if queries(i):
            best = sorted((-sum(x * y for x, y in zip(q, v)), j) for b, (j, v) in enumerate(whole) if a != b)[:k]
            out.update((i, r + 1, j, -s) for r, (s, j) in enumerate(best))
    return out


def test_search_is_exact(spark):
    rng = np.random.default_rng(2)
    vectors = [(i, rng.normal(size=8).round(2).tolist()) for i in range(150)] + [(200, [0.5] * 8), (201, [0.5] * 8), (202, None), (203, [None] + [1.0] * 7), (204, [float("nan")] + [1.0] * 7), (205, [float("inf")] * 8), (None, [1.0] * 8), (206, [1.0, 2.0]), (0, None), (200, [0.5] * 8), (7, [0.25] * 8), (220, [])]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in vectors], "vec_id long, embedding array<double>, score int, at string")
    for tree_rows, block in ((40, 5), (8, 3), (8192, 4096)):
        got = metric_search.top_k(frame, F.col("vec_id") % 20 == 0, k=7, tree_rows=tree_rows, block=block, fanout=4, page=8)
        assert Counter(map(tuple, got.collect())) == nearest(vectors, 7, lambda i: i % 20 == 0)
    assert metric_search.top_k(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert metric_search.top_k(frame.where("vec_id = 40"), F.col("vec_id") % 20 == 0).count() == 0


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, [float(x) for x in rng.integers(-(1 << 21), 1 << 21, 8)]) for i in range(60)] + [(60, [32768.0] * 8), (61, [32768.0] * 8)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    assert Counter(map(tuple, metric_search.top_k(frame, F.col("vec_id") % 20 == 0, k=5, tree_rows=16, page=4).collect())) == nearest(vectors, 5, lambda i: i % 20 == 0)
    huge = spark.createDataFrame([(0, [1e9, 1e9]), (1, [1e9, 1e9])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="more than 64 bits"):
        metric_search.top_k(huge, F.col("vec_id") == 0).collect()


def test_bounds_avoid_products(spark):
    """In balls around far centres most trees, pages and vectors are never multiplied."""
    rng = np.random.default_rng(6)
    centres = rng.integers(-2000, 2000, (20, 6))
    held = (centres[np.arange(2000) % 20] + rng.integers(-20, 20, (2000, 6))).astype(np.int64)
    ids = np.arange(2000, dtype=np.int64)
    tree = metric_search.unpacked(metric_search.packed(0, ids, ids, held, 8, 32), 6)
    scale = metric_search.Scale(6, 6 * float(np.abs(held).max()) ** 2)
    queries = held[::100]
    row, found, score, taken = metric_search.search(tree, scale, ids[::100], queries, np.full(20, metric_search.LOWEST), 10)
    for k in range(20):
        want = sorted((-int(queries[k] @ v), int(i)) for i, v in zip(ids, held) if i != ids[::100][k])[:10]
        assert [(-int(s), int(i)) for r, i, s in zip(row, found, score) if r == k] == want
    assert taken < 0.5 * 20 * 2000
    frame = spark.createDataFrame([(int(i), v.astype(float).tolist()) for i, v in zip(ids, held)], "vec_id long, embedding array<double>")
    rows = metric_search.top_k(frame, F.col("vec_id") % 100 == 0, k=10, scale=1, tree_rows=800, page=32)
    assert Counter(map(tuple, rows.collect())) == nearest([(int(i), v.tolist()) for i, v in zip(ids, held)], 10, lambda i: i % 100 == 0, 1)


# --- 3, WARC


def test_warc_round_trip(spark, tmp_path):
    html = [(1, "http://b.example.com/x", "h" * 1500), (2, "http://a.example.com/x", "h" * 1500), (3, None, "h" * 1500), (4, "http://a.example.com/?q=é", None), (5, "weird url\r\nX: y", "short"), (6, "http://a.example.com/x", "short"), (2, "http://a.example.com/x", "h" * 1500), (None, "http://c.org", "h" * 1500), (-7, "http://c.org", "日本" * 600)]
    pages = spark.createDataFrame(html, "page_id long, url string, html string")
    got = Counter(tuple(r) for r in warc.round_trip(pages).collect())
    import hashlib

    want = Counter()
    for i, _, h in html:
        raw = (h or "").encode()
        big = [j for j, _, g in html if g == h and len(raw) >= 1000 and j is not None]
        to = max(big) if big and i != max(big) else None
        want[i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if to is not None else "response", to] += 1
    assert got == want
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_lookup_reads_one_block(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h{i % 7}.example.com/{i}", f"page {i} " * 20) for i in range(60)], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/w"
    directory = warc.write_archives(pages, folder, block_captures=4)
    keys = pages.where("page_id % 9 = 0").select(warc.capture_key(F.col("url"), F.col("page_id")).alias("key")).unionByName(spark.createDataFrame([("zzz",), ("",)], "key string"))
    got = {bytes(r["payload"]).decode() for r in warc.look_up(keys, directory, folder).collect()}
    assert got == {f"page {i} " * 20 for i in range(0, 60, 9)}


def test_lookups_go_through_groups_of_archives(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h{i % 17}.example.com/{i}", f"page {i} " * 20) for i in range(90)], "page_id long, url string, html string").repartition(3)
    directory = warc.write_archives(pages, f"file://{tmp_path}/w", block_captures=3)
    keys = pages.select(warc.capture_key(F.col("url"), F.col("page_id")).alias("key"))
    found = warc.archive_of(keys, directory, group=2).collect()
    ranges = directory.groupBy("archive").agg(F.min("first_key").alias("a"), F.max("last_key").alias("b")).collect()
    held = {r["archive"]: (r["a"], r["b"]) for r in ranges}
    assert len(found) == 90 and len(held) > 2 and all(held[r["archive"]][0] <= r["key"] <= held[r["archive"]][1] for r in found)


# --- 6, URLs


def test_names_for_reputation(spark):
    rows = [("a.b.example.co.uk", "a.b.example.co.uk", "example.co.uk", "co.uk"), ("a.example.com:8080", "a.example.com", "example.com", "com"), ("example.com.", "example.com", "example.com", "com"), ("10.0.0.1", "10.0.0.1", "10.0.0.1", "10.0.0.1"), ("[::1]:80", "[::1]", "[::1]", "[::1]"), ("co.uk", "co.uk", "co.uk", "co.uk"), ("localhost", "localhost", "localhost", "localhost"), ("", "", "", ""), ("x.y.gov.zz:", "x.y.gov.zz", "y.gov.zz", "gov.zz"), ("u.v.k12.ca.us", "u.v.k12.ca.us", "v.k12.ca.us", "k12.ca.us")]
    suffixes = (*url_filter.TWO_LABEL_SUFFIXES, "gov.zz", "k12.ca.us")
    name = url_filter.reputation_name(F.col("host"))
    got = spark.createDataFrame([(k, r[0]) for k, r in enumerate(rows)], "k int, host string").select("k", "host", name.alias("name")).select("k", "host", "name", url_filter.domain_of(F.col("name"), suffixes).alias("d"), url_filter.suffix_of(F.col("name"), suffixes).alias("s")).orderBy("k").collect()
    assert [tuple(r)[1:] for r in got] == rows


def test_ports_share_a_reputation(spark):
    outcomes = spark.createDataFrame([("bad.io:8080", 1)] * 30 + [("good.io", 0)] * 40, "host string, bad int")
    got = url_filter.filter_urls(spark.createDataFrame([("http://bad.io./x",), ("http://good.io:1/",), ("http://bad.io:9/",)], "url string"), outcomes, {})
    assert {r["host"]: r["verdict"] for r in got.collect()} == {"bad.io.": "block", "good.io:1": "allow", "bad.io:9": "block"}


def test_urls(spark):
    urls = [("http://EXAMPLE.net/en/1", "example.net", "/en/1", "example.net/en/", "allow"), ("http://a.example.net/de", "a.example.net", "/de", "net/", "block"), ("x://net?q", "net", "", None, None), ("http://badexample.net/en/", "badexample.net", "/en/", "net/", "block"), (None, "", "", None, None), ("no scheme/net/", "", "", None, None), ("http://s.org/fr/#x", "s.org", "/fr/", "org/fr/", "allow"), ("http://www.example.com/de/?a", "www.example.com", "/de/", "example.com/de/", "block")]
    pages = spark.createDataFrame([(i, u[0], 5) for i, u in enumerate(urls)], "page_id int, url string, host int")
    outcomes = spark.createDataFrame([("good.io", 0)] * 40 + [("bad.io", 1)] * 30 + [("x.bad.io", None)], "host string, bad int")
    got = {r["page_id"]: r for r in url_filter.filter_urls(pages, outcomes, RULES).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(urls):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert verdict is None or got[i]["verdict"] == verdict
    judged = url_filter.filter_urls(spark.createDataFrame([("http://bad.io/",), ("http://good.io/",), ("http://new.bad.io/",)], "url string"), outcomes, {})
    assert [r["verdict"] for r in judged.orderBy("url").collect()] == ["block", "allow", "block"]
    assert url_filter.filter_urls(pages, outcomes.limit(0), RULES).count() == len(urls)


# --- 5 and 9, classifiers


def test_ftrl_by_hand():
    """Three features and two classes, one step after the other in plain numbers."""
    import math

    rows = [(np.array([0, 2]), np.array([0.6, 0.8])), (np.array([1]), np.array([1.0])), (np.array([0, 1]), np.array([0.8, 0.6])), (np.array([2]), np.array([1.0]))]
    y, alpha, beta, l1, l2 = [0, 1, 1, 0], 0.3, 1.0, 0.02, 0.1
    got, bias = language_id.ftrl(rows, np.array(y), 2, 3, alpha, beta, l1, l2, epochs=3, seed=5)
    z, n = [[0.0, 0.0] for _ in range(4)], [[0.0, 0.0] for _ in range(4)]

    def weight(i, c):
        lean = 0.0 if i == 3 else l1
        return 0.0 if abs(z[i][c]) <= lean else -(z[i][c] - math.copysign(lean, z[i][c])) / ((beta + math.sqrt(n[i][c])) / alpha + l2)

    order = np.random.default_rng(5)
    for _ in range(3):
        for k in order.permutation(4):
            at = [(int(i), float(x)) for i, x in zip(*rows[k])] + [(3, 1.0)]
            w = {(i, c): weight(i, c) for i, _ in at for c in (0, 1)}
            logits = [sum(x * w[i, c] for i, x in at) for c in (0, 1)]
            p = [math.exp(v) / sum(map(math.exp, logits)) for v in logits]
            for i, x in at:
                for c in (0, 1):
                    g = (p[c] - (y[k] == c)) * x
                    z[i][c] += g - (math.sqrt(n[i][c] + g * g) - math.sqrt(n[i][c])) / alpha * w[i, c]
                    n[i][c] += g * g
    assert np.allclose(got, [[weight(i, c) for c in (0, 1)] for i in range(3)]) and np.allclose(bias, [weight(3, c) for c in (0, 1)])


def test_likelihood_ratio(spark):
    import math

    def plain(a, b, t, o):
        log = lambda k, n, p: (k * math.log(p) if k else 0) + ((n - k) * math.log(1 - p) if n > k else 0)
        return 2 * (log(a, t, a / t) + log(b, o, b / o) - log(a, t, (a + b) / (t + o)) - log(b, o, (a + b) / (t + o)))

    pairs = [(5, 1), (1, 0), (20, 0), (20, 60), (0, 3)]
    got = spark.createDataFrame(pairs, "a long, b long").select(toxicity.ratio_test(F.col("a"), F.col("b"), 20, 60).alias("x")).collect()
    assert np.allclose([r["x"] for r in got], [plain(a, b, 20, 60) for a, b in pairs])


def test_dictionaries_are_trained():
    samples = [f" {w} {prose(k, 3)} ".encode() for k in range(300) for w in ("vozzengrub", "qwuzzler")]
    made = toxicity.trained(samples, 1024)
    assert made[:4] == bytes.fromhex("37a430ec") and b"grub" in made and b"zzler" in made and len(made) <= 1024
    assert toxicity.trained([b"few"], 1024) == b"few"


def test_languages(spark):
    syllables = {"aa": "zu ka to", "bb": "wi re lö", "cc": "ña che os"}
    rng = random.Random(8)
    rows = [(i, " ".join("".join(rng.choices(syllables[lang].split(), k=3)) for _ in range(30)), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 60)]
    rows += [(500, None, "aa"), (501, "123 !!", "bb"), (502, "", None), (503, rows[0][1], None), (None, rows[1][1], "bb")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language_id.identify(frame).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows[:180]) and got[503]["lang_pred"] == "aa"
    assert [got[i]["lang_pred"] for i in (500, 501, 502)] == ["und"] * 3
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(180))
    assert language_id.identify(frame.limit(0)).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(frame.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_toxicity(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(600):
        words, toxic = prose(1000 + i, 80).split(), i % 5 == 0
        for _ in range(4 if toxic else 0):
            words[rng.randrange(80)] = rng.choice(["vozzengrub", "qwuzzler", "xyphgnaw"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(1000, None), (1001, ""), (None, "some text")]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels + [(1000, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_documents(docs, marks).collect()}
    held = [i for i in range(600) if got[i]["held_out"]]
    assert held == [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2]
    right = sum(got[i]["predicted"] == (i % 5 == 0) for i in held)
    assert right >= 0.95 * len(held)
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got.values())
    assert {r["score"] for r in toxicity.score_documents(docs, marks.limit(0)).collect()} == {0.0}
    assert toxicity.score_documents(docs.limit(0), marks).count() == 0


# --- very long texts, and columns with the operators' own names


LONG_WORDS = 1_000_000


@pytest.fixture(scope="module")
def long_docs(spark):
    """Two equal texts of more than 5 MB, one of blanks, one of one word; columns that operators use themselves."""
    text = prose(77, LONG_WORDS)
    assert len(text) > 5_000_000
    rows = [(1, text), (2, text), (3, " " * 5_000_000), (4, "x" * 5_000_000), (5, "same word " * 500_000), (6, prose(78, 40)), (7, None)]
    names = "bit row n s1 cid digest group score held_out predicted lang_pred at cell sequence_id offset size slot spans"
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return frame.withColumns({c: F.lit(1) for c in names.split()} | {"lang": F.lit("en")})


def test_long_texts_in_joins_and_chunks(long_docs):
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(long_docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7}
    kept = {r["doc_id"]: r["text"] for r in substrings.dedup_substrings(long_docs).collect()}
    assert kept[2] == "" and kept[1] == prose(77, LONG_WORDS) and kept[6] == prose(78, 40) and kept[7] is None


def test_long_texts_in_packing_and_tiling(spark, long_docs):
    packed = packing.pack_documents(long_docs, *tokenizer())
    assert {r["doc_id"]: r["n"] for r in packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}[3] == 5_000_001
    items = spark.createDataFrame([(1, " ".join(prose(77, LONG_WORDS).split()[:50])), (2, "same word " * 30)], "item_id int, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(long_docs, items).collect()} == {(1, 1), (2, 1), (5, 2)}


def test_long_texts_in_classifiers(spark, long_docs):
    more = spark.createDataFrame([(10 + k, prose(3000 + k, 60) + (" vozzengrub" * 3 if k % 3 == 0 else "")) for k in range(150)], "doc_id long, text string")
    docs = long_docs.select("doc_id", "text").unionByName(more)
    marks = more.select("doc_id", F.when(F.col("text").contains("vozzengrub"), 1).otherwise(0).alias("toxic"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs.withColumns({"score": F.lit(1), "toxic": F.lit(1), "half": F.lit(1)}), marks).collect()}
    assert len(scores) == 157 and all(0 <= x <= 1 for x in scores.values())
    langs = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(long_docs.withColumn("judged", F.lit(1))).collect()}
    assert langs == {1: "en", 2: "en", 3: "und", 4: "en", 5: "en", 6: "en", 7: "und"}


def test_long_texts_in_archives_and_shards(spark, long_docs):
    pages = long_docs.select(F.col("doc_id").alias("page_id"), F.lit("http://a.example.com/x").alias("url"), F.col("text").alias("html"), F.lit(1).alias("kind"), F.lit("k").alias("key"))
    got = {r["page_id"]: (r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages).collect()}
    assert got[1] == (len(prose(77, LONG_WORDS)), "revisit", 2) and got[2][1:] == ("response", None) and got[7] == (0, "response", None)
    shards = sharding.shuffle_shards(long_docs, 3).collect()
    assert len(shards) == 7 and sorted((r["shard"], r["slot"]) for r in shards) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (2, 0), (2, 1)]
    urls = spark.createDataFrame([("http://a.io/" + "x" * 5_000_000, 1, 2), (None, 1, 2), ("http://" + "a." * 1_000_000 + "io/", 1, 2)], "url string, host int, verdict int")
    assert [r["verdict"] for r in url_filter.filter_urls(urls, spark.createDataFrame([], "host string, bad int"), RULES).select("verdict").collect()] == ["allow"] * 3


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from quillon.llm import storage

    none = SimpleNamespace(get=lambda *_: None)
    session = lambda master: SimpleNamespace(conf=none, sparkContext=SimpleNamespace(getConf=lambda: none, master=master, applicationId="app"))
    for master in ("spark://x:1", "yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            storage.shared_dir(session(master))
    assert storage.shared_dir(session("local[4]")).startswith("file://")


# --- the queries


def test_thirteen_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    import os

    import duckdb

    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for table in os.listdir(sf):
        con.sql(f"create view {table.removesuffix('.parquet')} as select * from '{sf}/{table}'")
    got, want = QUERIES[name](spark, sf), con.sql(ORACLE_SQL[name])
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    assert sorted(str(tuple(r[c] for c in columns)) for r in got.collect()) == sorted(map(str, want.project(", ".join(columns)).fetchall()))
