"""Half-open numeric bins with an explicit place for nulls."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bins:
    """``(-inf, e0) [e0, e1) ... [en, inf)``, one label per bin.

    The bin number is how many edges a value is *not below*.  A null is below
    none of them, so it lands in the last bin.
    """

    edges: tuple[float, ...]
    labels: tuple[str, ...]

    def __post_init__(self) -> None:
        if len(self.labels) != len(self.edges) + 1:
            raise ValueError("bins need one label more than edges")
        if list(self.edges) != sorted(set(self.edges)):
            raise ValueError("bin edges must ascend")

    def id(self, value: Column) -> Column:
        return reduce(add, (F.when(value < edge, 0).otherwise(1) for edge in self.edges))

    def label(self, bin_id: Column) -> Column:
        return F.get(F.lit(list(self.labels)), bin_id)


# The satisfaction bands of a given score.
SCORE_BINS = Bins(
    (5.0, 7.5, 9.0),
    ("< 5.0 (angry)", "5.0-7.5 (disappointed)", "7.5-9.0 (satisfied)", ">= 9.0 (happy)"),
)

# The prestige bands of a published score.
PRESTIGE_BINS = Bins(
    (7.5, 8.5, 9.2),
    ("economy (< 7.5)", "standard (7.5-8.5)", "premium (8.5-9.2)", "luxury (>= 9.2)"),
)
