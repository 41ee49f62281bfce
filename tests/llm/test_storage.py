"""Files of written tables and of the shuffles before them."""

from __future__ import annotations

import time
from pathlib import Path

from pyspark.sql import functions as F

from quillon.llm import storage


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f.name for d in dirs for f in Path(d.getPath()).rglob("shuffle_*")}


def test_shuffle_files_go_with_the_query(spark):
    """A table's shuffles go when it is written, without garbage collection; the frame can still be read."""
    before = shuffle_files(spark)
    frame = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(3, "count")
    storage.written(frame, "table")
    for _ in range(100):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.05)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(storage.CLEANUP, "false") == "false"
    assert frame.count() == 7
