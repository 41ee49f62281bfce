"""Words and word shingles of whole Arrow columns, as 64-bit hashes, in numpy.

A word is a run of bytes other than 0x20 and 0x09 to 0x0D; A-Z count as a-z.
Words of up to eight bytes have hashes that differ if they do and are as long;
longer ones take XXH3.
Work goes over slices of bounded bytes (a single longer text is a slice).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: For comparing by letters and digits alone: all other ASCII separates words.
PUNCTUATION = np.array([chr(b).isascii() and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of each number over all its bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its rows' bounds in them; a null is empty."""
    wide = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = wide.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[wide.offset : wide.offset + len(wide) + 1] if len(wide) else np.zeros(1, np.int64)
    held = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[bounds[0] : bounds[-1]], bounds - bounds[0]


class Words(NamedTuple):
    """Words in order: the slice's row, first byte, byte after the last (in the slice's bytes), hash; ``rows`` is the number of rows."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    rows: int


def words(data: np.ndarray, bounds: np.ndarray, between: np.ndarray = SPACE) -> Words:
    rows = len(bounds) - 1
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, none.astype(np.uint64), rows)
    space = between[data]
    first, last = ~space, ~space
    edges = bounds[1:-1]
    inner = edges[(edges > 0) & (edges < len(data))]
    before = np.concatenate([[True], space[:-1]])
    after = np.concatenate([space[1:], [True]])
    before[inner] = True
    after[inner - 1] = True
    start, end = np.flatnonzero(first & before), np.flatnonzero(last & after) + 1
    row = np.searchsorted(bounds, start, side="right") - 1
    if not len(start):
        return Words(row, start, end, np.zeros(0, np.uint64), rows)
    return Words(row, start, end, word_hashes(_LOWER[data], start, end), rows)


def word_hashes(lowered: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash for each run of bytes ``start`` to ``end`` of ``lowered``."""
    size = (end - start).astype(np.uint64)
    held = np.concatenate([lowered, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(lowered),), dtype="<u8", buffer=held, strides=(1,))[start].astype(np.uint64)
    short = np.minimum(size, np.uint64(8)) * np.uint64(8)
    with np.errstate(over="ignore"):
        out = mixed((eight & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - short))) + BASE * size)
    long = np.flatnonzero(size > np.uint64(8))
    raw = lowered.tobytes() if len(long) else b""
    out[long] = [xxhash.xxh3_64_intdigest(raw[a:b], 1) for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True)]
    return out


def slices(column: pa.Array, at_most: int = SLICE_BYTES, between: np.ndarray = SPACE) -> Iterator[tuple[int, Words, np.ndarray, np.ndarray]]:
    """(first row, words, bytes, bounds) of consecutive rows that together have about ``at_most`` bytes."""
    data, bounds = utf8(column)
    first = 0
    while first < len(bounds) - 1:
        end = max(first + 1, int(np.searchsorted(bounds, bounds[first] + at_most, side="right")) - 1)
        part = data[bounds[first] : bounds[end]]
        at = bounds[first : end + 1] - bounds[first]
        yield first, words(part, at, between), part, at
        first = end


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``size`` words; a row with fewer has its whole sequence as one, a row without words none."""
    n = len(w.row)
    with np.errstate(over="ignore"):
        count = np.bincount(w.row, minlength=w.rows)
        starts = np.concatenate([[0], np.cumsum(count)])
        full = max(0, n - size + 1)
        h = np.zeros(full, np.uint64)
        for k in range(size):
            h = h * STEP + w.hash[k : k + full]
        whole = w.row[:full] == w.row[size - 1 :][:full]
        rows, hashes = [w.row[:full][whole]], [h[whole]]
        for length in range(1, size):
            short = np.flatnonzero(count == length)
            g = np.zeros(len(short), np.uint64)
            for k in range(length):
                g = g * STEP + w.hash[starts[short] + k]
            rows.append(short)
            hashes.append(g + np.uint64(size - length) * BASE)
        return np.concatenate(rows), mixed(np.concatenate(hashes))


def distinct(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted pairs without repeats."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    keep = np.ones(len(row), dtype=bool)
    keep[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[keep], value[keep]
