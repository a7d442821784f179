"""Texts of an Arrow batch as one byte array, cut into words, lines and hashes.

All functions work on whole texts. A batch is handled in runs of documents of
half a megabyte, so the working memory follows the run (or the longest single
text), never the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 19
#: Bytes hashed at a time: their 64-bit prefix sums stay in a core's cache.
HASH_BYTES = 1 << 16
_RNG = np.random.default_rng(20240229)
#: 64 random bits for each byte; the second table takes A-Z as a-z.
BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_LOWER = BYTE.copy()
BYTE_LOWER[65:91] = BYTE[97:123]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def text_array(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n + 1 offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_binary(column.type) or pa.types.is_string(column.type):
        kind = np.int32
    elif pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        return text_array(column.cast(pa.large_string()))
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, kind, n + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def runs(off: np.ndarray, limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents with at most ``limit`` bytes, or one document."""
    a, n = 0, len(off) - 1
    while a < n:
        b = int(np.searchsorted(off, off[a] + limit, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, RUN_BYTES + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * RUN_BYTES:  # a single huge text does not stay in memory
            _powers[base] = have
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64 bits."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def prefix_hash(data: np.ndarray, table: np.ndarray = BYTE) -> np.ndarray:
    """Prefix sums for span_hash (wrapping 64-bit arithmetic)."""
    out = np.zeros(len(data) + 1, np.uint64)
    term = table.take(data)
    term *= powers(_BASE, len(data))
    np.cumsum(term, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed 64-bit hashes of the byte spans [start, end): equal bytes, equal hash."""
    raw = (prefix[end] - prefix[start]) * powers(_INVERSE, len(prefix))[start]
    return mix64(raw + (end - start).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray = BYTE) -> np.ndarray:
    """``span_hash`` of spans that follow one another, made from ``HASH_BYTES``
    of text at a time, so that the prefix sums stay small."""
    out = np.empty(len(start), np.uint64)
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(start, start[a] + HASH_BYTES)))
        low, high = start[a], end[b - 1]
        out[a:b] = span_hash(prefix_hash(data[low:high], table), start[a:b] - low, end[a:b] - low)
        a = b
    return out


def stable_order(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of 64-bit unsigned values, and the values in that order.

    The low bits of each value make room for its position, which is sorted
    along; values that differ in those bits only, and come out in the wrong
    order, are rare among hashes: then all are sorted the plain way."""
    low = np.uint64((1 << max(1, len(value).bit_length())) - 1)
    key = value & ~low
    key |= np.arange(len(value), dtype=np.uint64)
    key.sort()
    key &= low
    by = key.view(np.int64)
    ordered = value[by]
    if (ordered[1:] < ordered[:-1]).any():
        by = np.argsort(value, kind="stable")
        ordered = value[by]
    return by, ordered


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words of each document."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off) - 1, np.int64)
    inside = (data != 32) & (data - np.uint8(9) > 4)
    first, last = inside.copy(), inside.copy()
    np.greater(inside[1:], inside[:-1], out=first[1:])
    np.greater(inside[:-1], inside[1:], out=last[:-1])
    edge = off[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    first[edge] = inside[edge]          # a document ends a word
    last[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    at = np.searchsorted(start, off)
    return start, end, np.diff(at)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values over [bounds[i], bounds[i + 1]), empty ranges 0."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
