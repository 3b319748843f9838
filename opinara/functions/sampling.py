"""Sampling and shuffling by a hash of the row's own key.

``sample``, ``randomSplit`` and ``rand`` depend on how rows are partitioned, so
a lost executor or another cluster size changes the answer.  A threshold on a
hash of the key does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_RANGE = 2**32


def hash_order(*keys: str | Column, seed: int | str) -> Column:
    """Uniform 32-bit number from the key columns and a seed."""
    digest = F.md5(F.concat_ws("|", *keys, F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def in_fraction(*keys: str | Column, fraction: float, seed: int | str) -> Column:
    """True for about ``fraction`` of the keys, always the same ones."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie in [0, 1]")
    return hash_order(*keys, seed=seed) < F.lit(round(fraction * _RANGE))
