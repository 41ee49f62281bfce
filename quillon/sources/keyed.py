"""Tables whose rows are replaced by key, safe for several writers (SNK-2, SNK-3, SNK-9, JN-14).

Each version of a table is a folder of Parquet files.  It becomes the newest
when a file with the next number is made that names the folder, which the store
lets one writer alone do; who comes second makes its change anew on what the
first one left.  Readers see whole versions; old ones stay until they are
deleted.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _store(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _newest(spark: SparkSession, path: str, tries: int = 50) -> tuple[int, str | None]:
    """The newest version's number and folder, 0 and None before the first; waits for a writer that is about to name its folder."""
    files, log = _store(spark, f"{path}/_versions")
    for _ in range(tries):
        names = sorted(s.getPath().getName() for s in files.listStatus(log)) if files.exists(log) else []
        if not names:
            return 0, None
        folder = spark.read.text(f"{path}/_versions/{names[-1]}", wholetext=True).first()
        if folder is not None and folder["value"]:
            return int(names[-1]), folder["value"]
        time.sleep(0.1)
    raise RuntimeError(f"{path}: version {names[-1]} names no folder; its writer was lost, and the file may be deleted")


def read_keyed(spark: SparkSession, path: str) -> DataFrame | None:
    """The table's newest version, None before the first."""
    _, folder = _newest(spark, path)
    return spark.read.parquet(f"{path}/{folder}") if folder else None


def changed(spark: SparkSession, path: str, change: Callable[[DataFrame | None], DataFrame], tries: int = 20) -> int:
    """Make ``change`` of the newest version (None before the first) the next one; its number."""
    for _ in range(tries):
        number, folder = _newest(spark, path)
        new = f"rows-{uuid.uuid4().hex}"
        change(spark.read.parquet(f"{path}/{folder}") if folder else None).write.parquet(f"{path}/{new}")
        files, claim = _store(spark, f"{path}/_versions/{number + 1:012d}")
        try:
            out = files.create(claim, False)
        except Py4JJavaError as refused:
            if "FileAlreadyExistsException" not in str(refused.java_exception):
                raise
            continue
        out.write(new.encode())
        out.close()
        return number + 1
    raise RuntimeError(f"{path}: other writers were first {tries} times")


def upsert(rows: DataFrame, path: str, *key: str) -> int:
    """SNK-2, SNK-9: ``rows`` take the place of those with their key, the others stay; rows of one key twice are an error.

    The rows are written once and then read by every try, so a retried write
    leaves no doubles.
    """
    if found := rows.groupBy(*key).count().where("count > 1").limit(1).collect():
        raise ValueError(f"a key repeats: {found[0].asDict()}")

    def change(held: DataFrame | None) -> DataFrame:
        return rows if held is None else held.join(rows.select(*key), list(key), "left_anti").select(*held.columns).unionByName(rows)

    return changed(rows.sparkSession, path, change)


def insert_missing(rows: DataFrame, path: str, *key: str) -> int:
    """SNK-3, JN-14: ``rows`` whose key isn't there yet are added; again, or by another writer as well, adds nothing."""

    def change(held: DataFrame | None) -> DataFrame:
        once = rows.dropDuplicates(list(key))
        return once if held is None else held.unionByName(once.join(held.select(*key), list(key), "left_anti").select(*held.columns))

    return changed(rows.sparkSession, path, change)


def delete(keys: DataFrame, path: str, *key: str) -> int:
    """The rows of ``keys`` go."""

    def change(held: DataFrame | None) -> DataFrame:
        if held is None:
            raise ValueError(f"{path}: no such table")
        return held.join(keys.select(*key), list(key), "left_anti").select(*held.columns)

    return changed(keys.sparkSession, path, change)


def with_status(spark: SparkSession, path: str, changes: DataFrame, key: str, column: str = "status") -> int:
    """SNK-9: overwrite ``column`` of the rows of ``changes`` (``key``, ``column``); a key that isn't there changes nothing."""

    def change(held: DataFrame | None) -> DataFrame:
        if held is None:
            raise ValueError(f"{path}: no such table")
        at = held.join(changes.select(key, F.col(column).alias("__new")), key, "left")
        return at.select(*[F.coalesce("__new", column).alias(column) if c == column else c for c in held.columns])

    return changed(spark, path, change)
