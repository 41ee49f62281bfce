"""The pipeline's stages on planted cases, each against brute force over what the stage before kept."""

from __future__ import annotations

import random
from collections import Counter

import pytest

import corpus_pipeline
from quillon.llm.toxicity import held_out, toxicity, train
from pyspark.sql import functions as F

from .conftest import prose
from .test_llm import brute_components, brute_dedup

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng, rows, labels = random.Random(3), [], []
    for i in range(260):
        words, toxic = prose(2000 + i, 70).split(), i % 5 == 0
        for _ in range(5 if toxic else 0):
            words[rng.randrange(70)] = rng.choice(["vozzengrub", "qwuzzler", "xyphgnaw"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic), 1))
    passage, items = prose(1, 80), [(k, prose(700 + k, 30)) for k in range(3)]
    near = prose(2, 200).split()
    for k in range(6):
        rows.append((300 + k, " ".join(near)))
        near[20 * k + 7] = f"new{k}"
    rows += [(310 + k, f"{prose(800 + k, 40)} {passage} {prose(850 + k, 30)}") for k in range(5)]
    rows += [(320 + k, f"{prose(900 + k, 30)} {items[k][1]} {prose(950 + k, 30)}") for k in range(3)]
    rows += [(330, None), (331, ""), (332, rows[1][1]), (None, "no id"), (333, prose(5, 4000))]
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(i, t, "en", None, None if t is None else len(t)) for i, t in rows], COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), items


def test_stages(spark, tables, tmp_path):
    folder, items = tables
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == before.columns
        kept.append(Counter((r["doc_id"], r["text"]) for r in docs.collect()) if k < 4 else docs.collect())
    first = Counter((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())

    model = train(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{folder}/labels.parquet").where(~held_out(F.col("doc_id"), 4, 2)))
    scored = spark.read.parquet(f"{folder}/documents.parquet").withColumn("score", toxicity(model, F.col("text")))
    assert kept[0] == Counter((r["doc_id"], r["text"]) for r in scored.where("score < 0.3").collect())
    gone = {i for i, _ in first - kept[0]}
    assert len([i for i in range(0, 260, 5) if i in gone]) >= 50 and len([i for i in gone if i >= 260 or i % 5]) <= 4

    rows = list(kept[0])
    by = {i: (n, c) for i, n, c in brute_components(rows)}
    want = {(i, t) for i, t in rows if i is None or by[i][0] == 0 or by[i][1] == i}
    assert set(kept[1]) == want and not {301, 302, 303, 304, 305, 332} & {i for i, _ in kept[1]}

    cut = brute_dedup(list(kept[1]))
    emptied = {i for i, t in kept[1] if t and t.strip()} & {i for i, t in cut if not (t or "").strip()}
    assert kept[2] == Counter({(i, t): n for (i, t), n in cut.items() if i not in emptied})
    assert sum(prose(1, 80) in (t or "") for _, t in kept[2]) == 1

    assert kept[3] == Counter({(i, t): n for (i, t), n in kept[2].items() if i not in (320, 321, 322)})
    assert {i for i, _ in kept[3]} == {r["doc_id"] for r in kept[4]}
    assert sum(r["length"] for r in kept[4]) <= 1024 * len({r["sequence_id"] for r in kept[4]})


def test_run_equals_its_stages(spark, tables):
    folder, _ = tables
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity"
    assert corpus_pipeline.run(spark, folder).select("doc_id").distinct().count() > 190
