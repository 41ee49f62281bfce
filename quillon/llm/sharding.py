"""Sharding by a two-pass external shuffle, in DataFrame functions only.

Pass 1 scatters the records into buckets by a seeded hash; the number of
buckets follows the data's bytes, so each bucket fits in memory.  Pass 2
numbers the records of each bucket, draws a Fisher-Yates permutation of these
numbers (Spark's ``shuffle`` of a sequence) and gives each record its place in
the whole shuffled order.  Place ``p`` of ``n`` shards goes to shard ``p mod n``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import with_offsets


def shuffle_shards(df: DataFrame, shards: int, seed: int = 7, size: str | None = None, bucket_bytes: int = 64 << 20, bucket_rows: int = 1 << 16) -> DataFrame:
    """Add ``shard`` (0 to ``shards`` - 1) and ``slot`` (from 0, gapless) to every row of ``df``.

    All columns take part in the hashes, so a value that many rows share in one
    column doesn't fill a bucket.  ``size`` names a column with the bytes of a
    row; buckets hold about ``bucket_bytes`` and ``bucket_rows``.  A bucket that
    rows equal in every column overfill is permuted in blocks of 4 x
    ``bucket_rows``.  Shards' row counts differ by one at most.

    Texts of any length move whole.  Nulls hash like any value; empty tables give none; repeated rows each get a
    place.  Columns of ``df`` named ``shard`` or ``slot`` are replaced, names
    that begin with ``__q_`` are taken.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    df = df.drop("shard", "slot")
    rows, held = df.agg(F.count(F.lit(1)), F.sum(F.col(size).cast("long") if size else F.lit(0))).first()
    buckets = max(1, -(-rows // bucket_rows), -(-int(held or 0) // bucket_bytes))
    columns = [F.col(f"`{c}`") for c in df.columns]
    scattered = df.withColumn("__q_bucket", F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(buckets))).withColumn("__q_at", F.xxhash64(F.lit(seed + 1), *columns))
    block = 4 * bucket_rows
    numbered = scattered.withColumn("__q_no", F.row_number().over(Window.partitionBy("__q_bucket").orderBy("__q_at")) - 1)
    counts = with_offsets(scattered.groupBy("__q_bucket").agg(F.count(F.lit(1)).alias("__q_n")), "__q_bucket", "__q_n", "__q_before")
    drawn = counts.repartition("__q_bucket").sortWithinPartitions("__q_bucket").withColumn("__q_order", fisher_yates(F.col("__q_n"), block, seed))
    inner = F.col("__q_no") % F.lit(block)
    place = F.col("__q_before") + (F.col("__q_no") - inner) + F.element_at(F.element_at("__q_order", (F.floor(F.col("__q_no") / F.lit(block)) + 1).cast("int")), (inner + 1).cast("int"))
    joined = numbered.join(drawn.hint("merge"), "__q_bucket").withColumn("__q_place", place)
    return joined.select(*columns, (F.col("__q_place") % shards).cast("int").alias("shard"), F.floor(F.col("__q_place") / F.lit(shards)).cast("long").alias("slot"))


def fisher_yates(n, block: int, seed: int):
    """For each block of at most ``block`` of the numbers 0 to ``n`` - 1, a random order of the block's numbers, from 0."""
    return F.transform(
        F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / F.lit(block))),
        lambda b: F.shuffle(F.sequence(F.lit(0).cast("long"), F.least(n - b * block, F.lit(block)) - 1), seed),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder for each shard, its rows in the order of ``slot``, in files of bounded length."""
    sharded.repartition("shard", F.floor(F.col("slot") / F.lit(1 << 18))).sortWithinPartitions("shard", "slot").write.option("compression", "zstd").partitionBy("shard").parquet(path)
