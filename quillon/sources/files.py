"""Files of any size: digests by streaming, ordered states in parts, lines with their numbers (SNK-6, SNK-8, SRC-7, SRC-10, SRC-15, DM-14).

A SHA-256 is of one stream, so a file is one task's work; it reads a megabyte
at a time, whatever the size.  Paths may be of any store that both Spark and
Arrow's file systems reach.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CHUNK = 1 << 20


def opened(path: str):
    """A stream of the file at ``path``, a plain path or a URI."""
    scheme, _, rest = path.partition(":")
    where, inner = (fs.LocalFileSystem(), "/" + rest.lstrip("/")) if scheme == "file" else fs.FileSystem.from_uri(path)
    return where.open_input_stream(inner, buffer_size=CHUNK)


def digests(files: DataFrame) -> DataFrame:
    """``files`` (path, byte_count) with their SHA-256, a file for a task at a time."""

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for path in frame["path"]:
                state = hashlib.sha256()
                with opened(path) as stream:
                    while chunk := stream.read(CHUNK):
                        state.update(chunk)
                found.append(state.hexdigest())
            yield frame.assign(sha256=found)

    return files.select("path", "byte_count").mapInPandas(hashed, "path string, byte_count long, sha256 string")


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """path and byte_count of all files below ``folder``; their contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", F.col("length").alias("byte_count"))


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """SNK-6: path below ``folder``, SHA-256 and bytes of every public file, by path; private folders and hidden files are left out."""
    root = folder.rstrip("/").split("://")[-1] + "/"
    public = listed(spark, folder).withColumn("file", F.substring_index("path", root, -1)).where(~F.col("file").rlike(r"(^|/)[._]"))
    return digests(public).select(F.substring_index("path", root, -1).alias("path"), "sha256", "byte_count").orderBy("path")


def write_state(spark: SparkSession, sections: dict[str, tuple[DataFrame, str]], folder: str) -> DataFrame:
    """DM-14, SNK-8: write a canonical state, and return its ``fingerprint`` and ``byte_count``.

    ``sections``: name to (rows: ``row`` as canonical JSON, ``key`` to sort by).
    Each section is sorted by ranges into text files that follow each other; the
    fingerprint is that of the whole state as one JSON object, read once as a
    stream, so no task or driver holds it.
    """
    for name, (rows, key) in sections.items():
        rows.repartitionByRange(key).sortWithinPartitions(key).select("row").write.mode("errorifexists").text(f"{folder}/{name}")
    parts = listed(spark, folder).select(F.regexp_extract("path", r"/([^/]+)/part-[^/]*$", 1).alias("section"), "path").where("section <> ''")
    files = parts.groupBy("section").agg(F.sort_array(F.collect_list("path")).alias("files"))
    names = spark.createDataFrame([(n,) for n in sorted(sections)], "section string").join(files, "section", "left").agg(F.array_sort(F.collect_list(F.struct("section", "files"))).alias("sections"))

    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for held in frame["sections"]:
                state, size = hashlib.sha256(), 0

                def put(data: bytes) -> None:
                    nonlocal size
                    state.update(data)
                    size += len(data)

                for k, section in enumerate(held):
                    put((("{" if k == 0 else ",") + f'"{section["section"]}":[').encode())
                    first = True
                    for path in section["files"] if section["files"] is not None else ():
                        with opened(path) as source:
                            rest = b""
                            while chunk := source.read(CHUNK):
                                *lines, rest = (rest + chunk).split(b"\n")
                                for line in lines:
                                    put(line if first else b"," + line)
                                    first = False
                    put(b"]")
                put(b"}")
                yield pd.DataFrame({"fingerprint": ["sha256:" + state.hexdigest()], "byte_count": [size]})

    return names.mapInPandas(stream, "fingerprint string, byte_count long")


def read_state(spark: SparkSession, folder: str, section: str, schema: str) -> DataFrame:
    """SRC-7: the rows of a section of a written state."""
    return spark.read.schema(schema).json(f"{folder}/{section}")


def numbered_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """SRC-10: position (from 0) and content of the lines that aren't blank, by file name and place in the file.

    Lines are numbered within the blocks that tasks read, and blocks, of which
    there are few, among each other; no task sees more than a block.
    """
    rows = spark.read.text(list(paths)).select(F.col("value").alias("content"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    kept = rows.where(F.trim(F.regexp_replace("content", r"\s", " ")) != "")
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = kept.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n")).select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inner = F.row_number().over(Window.partitionBy("file", "block").orderBy("id")) - 1
    return kept.withColumn("inner", inner).join(F.broadcast(starts), ["file", "block"]).select((F.col("start") + F.col("inner")).alias("position"), "content")
