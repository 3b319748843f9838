"""Texts of an Arrow batch as flat numpy arrays: bytes, words, hashes.

Words are the runs of bytes other than space and 0x09-0x0D.  Nothing here looks at
more than one chunk of rows, whose bytes are bounded unless one text is longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        _powers[base] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Chunk:
    """Some rows of a batch: ``data[bounds[i]:bounds[i + 1]]`` is the text of row ``first + i``."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def raw(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Rows of a text column, cut into chunks of about ``size`` bytes; null texts are empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1)
        last = min(last, n)
        yield Chunk(first, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first])
        first = last


@dataclass
class Words:
    """Words of a chunk: byte bounds in the chunk and the row each belongs to."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray

    def first_of(self, rows: int) -> np.ndarray:
        """Index of each row's first word, and the word count at the end."""
        return np.searchsorted(self.row, np.arange(rows + 1))


def words(chunk: Chunk) -> Words:
    text = ~SPACE[chunk.data]
    n = len(text)
    edge = np.zeros(n + 1, bool)
    edge[chunk.bounds] = True
    starts = text.copy()
    starts[1:] &= ~text[:-1] | edge[1:n]
    ends = text.copy()
    ends[:-1] &= ~text[1:] | edge[1:n]
    start = np.flatnonzero(starts)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(chunk.bounds, start, "right") - 1)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for every span."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=sums[1:])
    return mix((sums[end] - sums[start]) * powers(_INVERSE, n + 1)[start] + (end - start).astype(np.uint64))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, size: int = 1 << 17) -> np.ndarray:
    """``span_hashes`` of spans in rising order, some bytes of the text at a time."""
    out, first = np.empty(len(start), np.uint64), 0
    while first < len(start):
        last = max(first + 1, int(np.searchsorted(start, start[first] + size)))
        lo = start[first]
        out[first:last] = span_hashes(data[lo : end[last - 1]], start[first:last] - lo, end[first:last] - lo)
        first = last
    return out


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from every place on, the same as ``span_hashes`` up to its mark of the length."""
    n = len(data) - size + 1
    out = np.empty(max(n, 0), np.uint64)
    for first in range(0, n, CHUNK_BYTES // 2):
        last = min(n, first + CHUNK_BYTES // 2)
        part = data[first : last + size - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(part)), out=sums[1:])
        out[first:last] = mix((sums[size:] - sums[:-size]) * powers(_INVERSE, last - first))
    return out


def run_hashes(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hash of each of the spans that follow one another in ``data``."""
    out = np.empty(len(bounds) - 1, np.uint64)
    first = 0
    while first < len(out):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + CHUNK_BYTES, "right")) - 1)
        part = bounds[first : last + 1] - bounds[first]
        out[first:last] = span_hashes(data[bounds[first] : bounds[last]], part[:-1], part[1:])
        first = last
    return out


def ngrams(hashes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``n`` words within a row, and the index of its first word."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(count, np.uint64)
    for j in range(n):
        total = total * np.uint64(_BASE) + hashes[j : j + count]
    at = np.flatnonzero(row[:count] == row[n - 1 :])
    return mix(total[at]), at


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out
