"""Documents to packed training sequences, in stages that are each written and read again.

Every stage but the last returns the columns of ``documents``: toxic documents
go, one document of each group of near copies stays, repeated passages are cut
out, documents that hold benchmark items go, and the rest is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm.bits import without_keys
from quillon.llm.decontamination import contaminated
from quillon.llm.jaccard import jaccard_components
from quillon.llm.packing import pack_documents
from quillon.llm.queries import table, tokenizer
from quillon.llm.storage import scratch, written
from quillon.llm.substrings import dedup_substrings
from quillon.llm.toxicity import held_out, toxicity, train
from quillon.session import ship


def columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.3; learned from labels of documents that aren't held out.  Null and empty texts score as clean."""
    ship(spark)
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").where(~held_out(F.col("doc_id"), 4, 2))
    model = train(docs.select("doc_id", "text"), labels)
    scored = docs.withColumn("__q_score", toxicity(model, F.col("text")))
    return scored.where(F.col("__q_score") < 0.3).select(*columns(docs))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each component of near copies (5-word shingles, 0.8); of rows that repeat an id and a text, one.

    Documents without words link with nothing and stay, and so do documents without an id.
    """
    ship(spark)
    found = jaccard_components(docs.select("doc_id", "text"))
    others = found.where((F.col("n_shingles") > 0) & (F.col("doc_id") != F.col("component_id"))).select("doc_id")
    repeats = found.where("n_shingles > 0 and doc_id = component_id").groupBy("doc_id").count().where("count > 1").select("doc_id")
    kept = without_keys(docs, others.unionByName(repeats), "doc_id")
    if repeats.isEmpty():
        return kept
    return kept.unionByName(docs.join(repeats, "doc_id", "left_semi").select(*columns(docs)).dropDuplicates(["doc_id", "text"]))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one has; ``n_chars`` counts anew, and what had nothing else goes."""
    ship(spark)
    kept = dedup_substrings(docs)
    whole = kept.where(F.col("spans").isNull() | (F.trim("text") != ""))
    return whole.select(*[F.when(F.col("spans").isNotNull(), F.length("text").cast(docs.schema[c].dataType)).otherwise(F.col("n_chars")).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship(spark)
    found = contaminated(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return without_keys(docs, written(found, "contaminated"), "doc_id")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces, with their token ids and their places in sequences of at most 1024 tokens."""
    ship(spark)
    return pack_documents(docs.select("doc_id", "text"), *tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_sequences),
]

#: Compression lengths, chunk bounds and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        with scratch(spark):  # of a stage, its written result alone stays
            docs = written(stage(spark, docs, sf_dir), f"stage{k}", keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
