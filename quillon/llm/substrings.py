"""Substring deduplication by content-defined chunks.

A gear rolling hash (h = 2h + g[byte], 16 bits wide, so that it depends on the
last 16 bytes alone) cuts texts where its top bits are zero at the end of a
word.  An insertion moves bounds only within its own 16 bytes, so a passage
falls into the same chunks wherever it stands.  What is compared are windows:
the shortest runs of chunks, from each chunk on and up to each chunk, that are
long enough to be a passage.  Of each window's digest the first occurrence, by
document id, stays, and the bytes of later ones are cut out, so nothing goes
that didn't stand together in one earlier text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bits import divided
from .hot import hot_keys, salt, tasks
from .storage import scratch, written
from .words import mixed

GEAR = (mixed(np.arange(1, 257, dtype=np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def gear_hash(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte, by doubling its width of 1, 2, 4 and 8 bytes."""
    h = GEAR[data]
    for width in (1, 2, 4, 8):
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint16(width)
        h = wider
    return h


def chunk_ends(data: np.ndarray, bits: int = 2) -> np.ndarray:
    """Ends of the chunks of a text's bytes: one word end in 2^``bits``, and anywhere one character in 1024 that differs from that before it."""
    if not len(data):
        return np.zeros(0, np.int64)
    h, space = gear_hash(data), _SPACE[data]
    after = np.append(~space[1:], True)
    cut = space & after & (h >> np.uint16(16 - bits) == 0)
    starts = np.append((data[1:] & 0xC0) != 0x80, True)
    cut |= starts & ~space & (h >> np.uint16(6) == 0) & np.append(True, data[1:] != data[:-1])
    cut[-1] = True
    return np.flatnonzero(cut) + 1


def numbered(docs: DataFrame) -> DataFrame:
    """A written copy of ``docs`` with a number ``__q_row`` for each row."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(first, first + batch.num_rows)), *batch.columns], names=["__q_row", *batch.schema.names])
            first += batch.num_rows

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return written(docs.mapInArrow(number, f"__q_row long, {types}"), "copy")


def windows(sizes: np.ndarray, words: np.ndarray, least_words: int, least_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """(first chunk, chunk after the last) of the shortest runs of chunks, from each first chunk on and up to each last, that have ``least_words`` words or ``least_bytes`` bytes."""
    n, upto_words, upto_bytes = len(sizes), np.append(0, np.cumsum(words)), np.append(0, np.cumsum(sizes))
    ends = np.minimum(np.searchsorted(upto_words, upto_words[:-1] + least_words), np.searchsorted(upto_bytes, upto_bytes[:-1] + least_bytes))
    starts = np.maximum(np.searchsorted(upto_words, upto_words[1:] - least_words, side="right"), np.searchsorted(upto_bytes, upto_bytes[1:] - least_bytes, side="right")) - 1
    forward, backward = np.flatnonzero(ends <= n), np.flatnonzero(starts >= 0)
    both = np.unique(np.append(forward * (n + 1) + ends[forward], starts[backward] * (n + 1) + backward + 1))
    return both // (n + 1), both % (n + 1)


def windowed(copy: DataFrame, doc_id: str, text: str, least_words: int, least_bytes: int, rows: int = 1 << 16) -> DataFrame:
    """A row for each window of a numbered copy's texts: digest of its bytes, __q_row, __q_id and span (first byte << 32 | bytes)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests: list[int] = []
            spans: list[np.ndarray] = []
            at: list[np.ndarray] = []

            def held() -> pa.RecordBatch:
                where = pa.array(np.concatenate(at))
                return pa.RecordBatch.from_arrays([pa.array(np.array(digests, np.uint64).view(np.int64)), batch.column(0).take(where), batch.column(2).take(where), pa.array(np.concatenate(spans))], names=["digest", "__q_row", "__q_id", "span"])

            for row, value in enumerate(batch.column(1)):
                raw = (value.as_py() or "").encode()
                if not raw:
                    continue
                data = np.frombuffer(raw, dtype=np.uint8)
                bounds = np.append(0, chunk_ends(data))
                begun = np.append(0, np.cumsum(~_SPACE[data] & np.append(True, _SPACE[data[:-1]])))
                first, after = windows(np.diff(bounds), np.diff(begun[bounds]), least_words, least_bytes)
                if len(first):
                    a, b = bounds[first], bounds[after]
                    digests += [xxhash.xxh3_64_intdigest(raw[x:y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
                    spans.append(a << 32 | b - a)
                    at.append(np.full(len(a), row))
                if len(digests) >= rows:
                    yield held()
                    digests, spans, at = [], [], []
            if digests:
                yield held()

    id_type = copy.schema[doc_id].dataType.simpleString()
    return copy.select("__q_row", F.col(f"`{text}`"), F.col(f"`{doc_id}`")).mapInArrow(cut, f"digest long, __q_row long, __q_id {id_type}, span long")


def later(occurrences: DataFrame, hot: list[int]) -> DataFrame:
    """__q_row and span of every occurrence of a digest in another row than its first.

    Sorted partitions are read as a stream, so a digest of any number of rows
    takes no memory.  The rows of ``hot`` digests are dealt over many groups:
    what isn't in the first row of its group is later; of the groups' first
    rows, which come back with their digest, the first of all is found.
    """
    id_type = occurrences.schema["__q_id"].dataType.simpleString()

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, owner = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            digest, row, group = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3).to_numpy()
            key = np.stack([digest, group])
            fresh = np.append(last is None or (last != key[:, 0]).any(), (key[:, 1:] != key[:, :-1]).any(0))
            firsts = np.append(owner, row[fresh])[np.cumsum(fresh)]
            last, owner = key[:, -1], firsts[-1]
            first = row == firsts
            told = pa.array(~first | (group >= 0))
            asked = pa.array(first & (group >= 0))
            none = pa.nulls(batch.num_rows, pa.int64()), pa.nulls(batch.num_rows, batch.column(4).type)
            columns = [batch.column(1), batch.column(2), pc.if_else(asked, batch.column(0), none[0]), pc.if_else(asked, batch.column(4), none[1])]
            yield pa.RecordBatch.from_arrays(columns, names=["__q_row", "span", "digest", "__q_id"]).filter(told)

    grouped = occurrences.withColumn("group", salt(F.col("digest"), hot, F.col("__q_row")))
    ordered = grouped.repartition("digest", "group").sortWithinPartitions("digest", "group", F.col("__q_id").asc_nulls_last(), "__q_row", "span")
    found = ordered.select("digest", "__q_row", "span", "group", "__q_id").mapInArrow(keep, f"__q_row long, span long, digest long, __q_id {id_type}")
    if not hot:
        return found.select("__q_row", "span")
    found = written(found, "later")
    asked = found.where("digest is not null")
    first = asked.groupBy("digest").agg(F.min(F.struct(F.col("__q_id").isNull().alias("none"), "__q_id", "__q_row")).alias("first"))
    others = asked.join(first, "digest").where("__q_row <> first.__q_row")
    return found.where("digest is null").select("__q_row", "span").unionByName(others.select("__q_row", "span"))


def merged(spans: np.ndarray) -> list[tuple[int, int]]:
    """(first byte, bytes) of the stretches that ``spans`` (first byte << 32 | bytes) cover together."""
    spans = np.sort(spans)
    starts = spans >> 32
    ends = np.maximum.accumulate(starts + (spans & 0xFFFFFFFF))
    fresh = np.append(True, starts[1:] > ends[:-1])
    return list(zip(starts[fresh].tolist(), (ends[np.append(fresh[1:], True)] - starts[fresh]).tolist(), strict=True))


def without(text: str, spans: list[tuple[int, int]]) -> str:
    raw, out, at = text.encode(), [], 0
    for start, size in spans:
        out.append(raw[at:start])
        at = start + size
    return b"".join([*out, raw[at:]]).decode()


def dedup_substrings(docs: DataFrame, least_words: int = 24, least_bytes: int = 600, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with later occurrences of repeated passages cut out of ``text``, and ``spans`` (first byte, bytes) of what was cut.

    A passage counts as repeated where consecutive chunks of at least
    ``least_words`` words or ``least_bytes`` bytes occurred together first in
    another row: one of a smaller id (null ids come last), or an earlier one of the
    same id.  What repeats within one text alone stays.  Null and empty texts stay as they
    are; a copy of a whole text becomes empty.  Texts of up to 2 GB are cut
    whole; an empty table gives none.  All other columns are kept; one named
    ``spans`` is replaced, names that begin with ``__q_`` are taken.
    """
    columns = [c for c in docs.columns if c != "spans"]
    copy = numbered(docs.select(*[F.col(f"`{c}`") for c in columns]))

    @F.pandas_udf("array<struct<start:int,length:int>>")
    def together(found: pd.Series) -> pd.Series:
        return pd.Series([[{"start": a, "length": n} for a, n in merged(np.asarray(x))] for x in found])

    @F.pandas_udf("string")
    def kept(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        return pd.Series([without(t, [(c["start"], c["length"]) for c in cut]) for t, cut in zip(texts, cuts, strict=True)])

    with scratch(docs.sparkSession):
        shown = windowed(copy.where(F.pmod(F.xxhash64("__q_row"), F.lit(64)) == 0), doc_id, text, least_words, least_bytes)
        again = later(windowed(copy, doc_id, text, least_words, least_bytes), hot_keys(shown.select("digest"), "digest", tasks(docs)))
        cut = written(again.groupBy("__q_row").agg(F.collect_list("span").alias("found")).select("__q_row", together("found").alias("spans")), "spans", keep=True)
    touched, rest = divided(copy, cut, "__q_row")
    changed = touched.join(cut.hint("merge"), "__q_row", "left")
    changed = changed.withColumn(text, F.when(F.col("spans").isNotNull(), kept(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.coalesce("spans", F.array().cast("array<struct<start:int,length:int>>")))).otherwise(F.col(f"`{text}`")))
    same = rest.withColumn("spans", F.lit(None).cast("array<struct<start:int,length:int>>"))
    return changed.select(*[F.col(f"`{c}`") for c in columns], "spans").unionByName(same.select(*[F.col(f"`{c}`") for c in columns], "spans"))
