"""Column expressions shared by the operators (all JVM-side, no Python UDF)."""

from opinara.functions.bins import PRESTIGE_BINS, SCORE_BINS, Bins
from opinara.functions.categories import first_match
from opinara.functions.sampling import hash_order, in_fraction
from opinara.functions.stats import ci95, rated, rounded, score_stats, share

__all__ = [
    "PRESTIGE_BINS",
    "SCORE_BINS",
    "Bins",
    "ci95",
    "first_match",
    "hash_order",
    "in_fraction",
    "rated",
    "rounded",
    "score_stats",
    "share",
]
