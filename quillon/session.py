"""Make the package importable in the Python workers of a session."""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add this package to the files of ``spark``'s application, once; what ``--py-files`` does on submission.

    Batches to and from Python are held to 4 MB, so long texts don't fill the
    workers.  Of a key that repeats in a JSON object the last value counts, as
    in Python's parser.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        top = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="quillon-py-")) / "quillon.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(top.rglob("*.py")):
                out.write(source, source.relative_to(top.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return spark


_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """A folder that the driver and all executors share: spark.checkpoint.dir, or, where it is unset and all is one process, a local one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return _OWN.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="quillon-shared-"))
