"""Columns of numbers as compressed bytes: what tasks hand to each other by bucket."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard


def packed(values: np.ndarray, rising: bool = False) -> bytes:
    """An int64 array; ``rising`` ones as differences, which compress better.  Bytes of equal weight stand together."""
    values = values.astype(np.int64)
    if rising and len(values):
        values = np.diff(values, prepend=0)
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked(blob: bytes, rising: bool = False) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1)
    values = np.ascontiguousarray(raw.T).view(np.int64).ravel()
    return np.cumsum(values) if rising else values


def joined(table: pa.Table, column: str, rising: bool = False) -> np.ndarray:
    """The arrays of all rows of a column one after the other."""
    parts = [unpacked(x, rising) for x in table.column(column).to_pylist()]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)
