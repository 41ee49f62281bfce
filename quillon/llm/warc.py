"""WARC archives with a two-level capture index.

Captures are range-sorted by their key (reversed host, then the rest of the
URL, then the capture id), so every archive file covers a range of keys.  Each
archive has an index file of sorted capture lines in gzip blocks; a sparse
directory keeps one row for each block: its first key and its place.  A lookup
binary-searches the archives' first keys (in two levels), then the directory,
reads that one block by its range, binary-searches its lines and reads one
record by its range.

Captures with equal payloads of some length are stored once: the others are
revisit records that refer to the one with the largest id.

Files are written by tasks to a shared folder under names of their own; only
those of attempts that succeeded are in the directory, so lost executors and
speculative tasks leave no wrong rows.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hot import join_totals
from .storage import new_path, written

CAPTURES = "page_id long, key string, record_type string, payload_bytes long, payload_digest string, refers_to long, refers_key string"
DIRECTORY = "archive string, index string, block int, first_key string, last_key string, offset long, length long, captures int"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def capture_key(url: Column, page_id: Column) -> Column:
    """``com,example,www)/path?query`` and the id as 20 digits; the id alone for null URLs.  White space and controls are written ``%20``."""
    host = F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    plain = F.when(host == "", url).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest))
    shifted = F.lpad((F.coalesce(page_id, F.lit(str(-(1 << 63))).cast("long")).cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    return F.concat_ws(" ", F.regexp_replace(F.coalesce(plain, F.lit("")), r"[\x00-\x20\x7f]", "%20"), shifted)


def captures(pages: DataFrame, least: int) -> DataFrame:
    """Captures (page_id, url, key, payload, digest, bytes) and, before a capture that is to be a revisit, a marker row of its key.

    The referred capture of a group of equal payloads is that with the largest
    id, then the largest key.  Groups are reduced before they move, and markers
    have no payload, so payloads move once: to their place in the archives.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", capture_key(F.col("url"), F.col("page_id")).alias("key"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("bytes", F.octet_length("payload").cast("long"))
    narrow = rows.where(F.col("bytes") >= least).select("page_id", "key", "digest")
    last = narrow.groupBy("digest").agg(F.max(F.struct("page_id", "key")).alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "last")
    marked = join_totals(narrow, last, "digest").where(F.coalesce(F.col("last.page_id") != F.col("page_id"), F.col("last.page_id").isNotNull()))
    markers = marked.select("key", "digest", F.col("last.page_id").alias("refers_to"), F.col("last.key").alias("refers_key"), F.lit(0).alias("kind"))
    return rows.withColumn("kind", F.lit(1)).unionByName(markers, allowMissingColumns=True)


def header_value(text: str | None) -> str:
    return "".join(c if c > " " and c != "\x7f" else "%20" for c in text or "")


def record(row: dict, date: str) -> bytes:
    """One WARC/1.1 record, as a gzip member of its own."""
    revisit = row["refers_key"] is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
    block = http if revisit else http + row["payload"]
    identity = "" if row["page_id"] is None else row["page_id"]
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, row['key'])}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", header_value(row["url"])),
        ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
        ("X-Capture-Id", identity),
    ]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, row['refers_key'])}>"), ("X-Refers-To-Capture-Id", row["refers_to"]), ("X-Refers-To-Key", row["refers_key"])]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(head.encode() + block + b"\r\n\r\n") + pack.flush()


class Capture(NamedTuple):
    fields: dict[str, str]
    payload: bytes | None

    @property
    def number(self) -> int | None:
        return int(self.fields["X-Capture-Id"]) if self.fields["X-Capture-Id"] else None


def parse(member: bytes) -> Capture:
    """Read a record back; a response whose payload doesn't have the stated digest raises."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else None
    if payload is not None and "sha1:" + hashlib.sha1(payload).hexdigest() != fields["WARC-Payload-Digest"]:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    return Capture(fields, payload)


def opened(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def write_archives(pages: DataFrame, folder: str, least: int = 1000, archive_bytes: int = 64 << 20, block_captures: int = 500, block_bytes: int = 4 << 20, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives and their indexes; return the block directory, a written table.

    Null html is an empty payload, a null URL an empty header.  Repeated rows
    are captures of their own.  A payload of any length up to 2 GB is one
    record.  Other columns are left out.  An empty table gives an empty
    directory.
    """
    typed = captures(pages, least)
    total = pages.agg(F.sum(F.octet_length("html").cast("long"))).first()[0] or 0
    archives = max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // archive_bytes))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = opened(folder)
        files.create_dir(path, recursive=True)
        name = f"captures-{uuid.uuid4().hex}"
        rows: list[tuple] = []
        lines: list[str] = []
        at = start = offset = 0
        current, marks = None, {}
        with files.open_output_stream(f"{path}/{name}.warc.gz", compression=None) as out, files.open_output_stream(f"{path}/{name}.cdx.gz", compression=None) as index:

            def close() -> None:
                nonlocal lines, offset, start
                block = gzip.compress("\n".join(lines).encode(), 6, mtime=0)
                index.write(block)
                key = lambda line: line.rpartition(" {")[0]
                rows.append((f"{name}.warc.gz", f"{name}.cdx.gz", len(rows), key(lines[0]), key(lines[-1]), offset, len(block), len(lines)))
                lines, offset, start = [], offset + len(block), at

            for batch in batches:
                columns = {n: batch.column(n) for n in batch.schema.names}
                for k in range(batch.num_rows):
                    row = {n: c[k].as_py() for n, c in columns.items()}
                    if row["key"] != current:
                        current, marks = row["key"], {}
                    if row["kind"] == 0:
                        marks[row["digest"]] = row["refers_to"], row["refers_key"]
                        continue
                    row["refers_to"], row["refers_key"] = marks.get(row["digest"], (None, None))
                    member = record(row, date)
                    out.write(member)
                    lines.append(f"{row['key']} {{{at},{len(member)}}}")
                    at += len(member)
                    if len(lines) >= block_captures or at - start >= block_bytes:
                        close()
            if lines:
                close()
        if rows:
            yield pa.RecordBatch.from_pydict({n: list(c) for n, c in zip(DIRECTORY.replace(",", "").split()[::2], zip(*rows, strict=True), strict=True)}, schema=pa.schema([(c.split()[0], {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[c.split()[1]]) for c in DIRECTORY.split(", ")]))
        else:
            files.delete_file(f"{path}/{name}.warc.gz")
            files.delete_file(f"{path}/{name}.cdx.gz")

    ranged = typed.repartitionByRange(archives, "key").sortWithinPartitions("key", "kind")
    return written(ranged.mapInArrow(write, DIRECTORY), "directory")


class Block:
    """The lines of one index block, read by its range."""

    def __init__(self, files, path: str, index: str, offset: int, length: int) -> None:
        with files.open_input_file(f"{path}/{index}") as source:
            lines = gzip.decompress(source.read_at(length, offset)).decode().split("\n")
        split = [line[:-1].rpartition(" {") for line in lines]
        self.keys = [key.encode() for key, _, _ in split]
        self.places = [tuple(map(int, place.split(","))) for _, _, place in split]


def read_archives(directory: DataFrame, folder: str) -> DataFrame:
    """Every capture of the archives (columns CAPTURES): block by block, each in any task; revisits have no payload here."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, path = opened(folder)
        for pdf in batches:
            for entry in pdf.itertuples():
                block = Block(files, path, entry.index_file, entry.offset, entry.length)
                first, end = block.places[0][0], sum(block.places[-1])
                with files.open_input_file(f"{path}/{entry.archive}") as source:
                    raw = source.read_at(end - first, first)
                out = []
                for key, (at, length) in zip(block.keys, block.places, strict=True):
                    got = parse(raw[at - first : at - first + length])
                    fields = got.fields
                    to = fields.get("X-Refers-To-Capture-Id")
                    out.append((got.number, key.decode(), fields["WARC-Type"], None if got.payload is None else len(got.payload), fields["WARC-Payload-Digest"].removeprefix("sha1:"), to and int(to), fields.get("X-Refers-To-Key")))
                yield pd.DataFrame(out, columns=CAPTURES.replace(",", "").split()[::2]).astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})

    tasks = int(directory.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return directory.withColumnRenamed("index", "index_file").repartition(tasks, "archive", "block").mapInPandas(read, CAPTURES)


def archive_of(keys: DataFrame, directory: DataFrame, group: int = 1024) -> DataFrame:
    """``keys`` (column ``key``) with the ``archive`` whose range may hold each.

    The archives are range-sorted by their first keys into groups of about
    ``group``; the groups' first keys go to the tasks (a million archives have
    a thousand), and a group's archives to the task that searches it.
    """
    tops = directory.groupBy("archive").agg(F.min("first_key").alias("first"))
    n = tops.count()
    ranged = written(tops.repartitionByRange(max(1, -(-n // group)), "first").withColumn("group", F.spark_partition_id().cast("long")), "tops")
    bounds = sorted((r["first"].encode(), r["group"]) for r in ranged.groupBy("group").agg(F.min("first").alias("first")).collect())
    firsts, names = [first for first, _ in bounds], [name for _, name in bounds]

    @F.pandas_udf("long")
    def group_of(key: pd.Series) -> pd.Series:
        return key.map(lambda x: names[max(0, bisect_right(firsts, x.encode()) - 1)] if names else -1)

    def place(archives: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        held = sorted(zip(archives["first"].map(str.encode), archives["archive"], strict=True))
        starts = [first for first, _ in held]
        return pd.DataFrame({"key": wanted["key"], "archive": [held[max(0, bisect_right(starts, x.encode()) - 1)][1] if held else None for x in wanted["key"]]})

    return ranged.groupBy("group").cogroup(keys.select("key", group_of("key").alias("group")).groupBy("group")).applyInPandas(place, "key string, archive string")


def look_up(keys: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """key, payload and payload_digest of the response captured under each of ``keys`` (column ``key``, no repeats); no row for keys that aren't there.

    The block directory of an archive goes only to the task that searches it.
    """

    def find(entries: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(entries) and len(wanted):
            files, path = opened(folder)
            entries = entries.assign(first=entries["first_key"].map(str.encode)).sort_values(["first", "block"]).reset_index(drop=True)
            starts, held, block = list(entries["first"]), -1, None
            with files.open_input_file(f"{path}/{entries['archive'].iloc[0]}") as source:
                for key in sorted(wanted["key"].map(str.encode)):
                    at = max(0, bisect_left(starts, key) - 1)
                    found = None
                    while found is None and at < len(starts) and starts[at] <= key:
                        if at != held:
                            held, block = at, Block(files, path, entries["index_file"].iloc[at], int(entries["offset"].iloc[at]), int(entries["length"].iloc[at]))
                        for k in range(bisect_left(block.keys, key), bisect_right(block.keys, key)):
                            offset, length = block.places[k]
                            got = parse(source.read_at(length, offset))
                            if got.payload is not None:
                                found = (key.decode(), got.payload, got.fields["WARC-Payload-Digest"].removeprefix("sha1:"))
                                break
                        at += 1
                    if found:
                        out.append(found)
        return pd.DataFrame(out, columns=["key", "payload", "payload_digest"])

    placed = archive_of(keys, directory)
    left = directory.withColumnRenamed("index", "index_file").groupBy("archive")
    return left.cogroup(placed.groupBy("archive")).applyInPandas(find, "key string, payload binary, payload_digest string")


def round_trip(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Write ``pages`` as archives, read all of them back and resolve the revisits through the index.

    page_id, payload_bytes, payload_digest, record_type and refers_to, a row
    for each page.  Rows that share the largest id of a group of equal payloads
    are all responses; null ids are smaller than any.  Null and empty pages
    have an empty payload and are responses; payloads of any length are written
    and read whole; an empty table gives no rows; other columns of ``pages``
    don't matter.
    """
    folder = new_path(pages.sparkSession, "warc")
    directory = write_archives(pages, folder, least)
    read = written(read_archives(directory, folder), "captures")
    revisits = read.where("record_type = 'revisit'")
    wanted = revisits.select(F.col("refers_key").alias("key")).distinct()
    found = look_up(wanted, directory, folder).select(F.col("key").alias("refers_key"), F.octet_length("payload").cast("long").alias("found_bytes"), F.col("payload_digest").alias("found_digest"))
    resolved = revisits.join(found, "refers_key", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    checked = F.when(F.col("found_digest") == F.col("payload_digest"), F.col("found_bytes")).otherwise(F.raise_error(F.concat(F.lit("no response for "), F.col("refers_key"))).cast("long"))
    return read.where("record_type = 'response'").select(*columns).unionByName(resolved.withColumn("payload_bytes", checked).select(*columns))
