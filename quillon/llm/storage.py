"""Intermediate tables in the folder that the driver and all executors share.

A written table cuts the lineage: a task that is run again after an executor
was lost reads files, not the steps before them.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_OWN: dict[str, str] = {}
#: Whether the shuffle files of a finished query are deleted at once.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SCRATCH: ContextVar[tuple[str, ...]] = ContextVar("scratch", default=())


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset and all is one process (tests), a new local one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="quillon-")
    return _OWN[app]


def new_path(spark: SparkSession, name: str, within: str | None = None) -> str:
    return f"{within or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are written inside, other than those to ``keep``, are deleted at the end."""
    outer = _SCRATCH.get()
    path = new_path(spark, "scratch", outer[-1] if outer else None)
    token = _SCRATCH.set((*outer, path))
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def files_for(rows: int) -> int:
    """How many files, or tasks, about so many narrow ``rows`` need."""
    return max(8, rows // 100_000)


def written(df: DataFrame, name: str, rows: int | None = None, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Where about how many ``rows`` it has is known, it becomes no more files
    than they need.  ``keep`` lets it outlive the innermost scratch().  Its
    shuffle files go when it is written, not when the driver happens to collect
    its garbage.
    """
    spark = df.sparkSession
    within = _SCRATCH.get()
    within = within[: len(within) - keep]
    if rows is not None:
        df = df.coalesce(files_for(rows))
    path = new_path(spark, name, within[-1] if within else None)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def with_offsets(counts: DataFrame, key: str, n: str, to: str, run: int = 4096) -> DataFrame:
    """Add to ``counts`` (one row per integer ``key``) the sum of ``n`` over all smaller keys.

    Two levels: windows over runs of ``run`` keys, then one over the sums of
    the runs, so no single task reads a row for every key.
    """
    runs = counts.withColumn("__run", F.floor(F.col(key) / F.lit(run)))
    inner = Window.partitionBy("__run").orderBy(key)
    before = Window.orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    sums = runs.groupBy("__run").agg(F.sum(n).alias("__sum"))
    sums = sums.select("__run", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"))
    within = F.sum(n).over(inner) - F.col(n)
    return runs.withColumn("__within", within).join(sums, "__run").withColumn(to, F.col("__base") + F.col("__within")).drop("__run", "__within", "__base")
