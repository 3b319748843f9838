"""Aggregate building blocks.

All of them are algebraic (count, sum, central moments), so Spark aggregates
before it shuffles and a hot group costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def share(condition: Column) -> Column:
    """Percentage of *all* rows of the group for which the condition is true."""
    return F.count(F.when(condition, 1)) / F.count(F.lit(1)) * 100


def score_stats(df: DataFrame, *keys: str | Column, extra: tuple[Column, ...] = ()) -> DataFrame:
    """Mean, row count and sample standard deviation of ``score`` per group, unrounded."""
    return df.groupBy(*keys).agg(
        F.avg("score").alias("mean_score"),
        F.count(F.lit(1)).alias("n"),
        F.stddev_samp("score").alias("std_score"),
        *extra,
    )


def ci95(std: Column, n: Column) -> Column:
    """Half width of the normal 95 % interval of a mean."""
    return F.lit(1.96) * (std / F.sqrt(n))


def rated(reviews: DataFrame, drop_null_score: bool) -> DataFrame:
    """All reviews, or only those with a score: by default a missing score counts in group sizes and percentages."""
    return reviews.filter(F.col("score").isNotNull()) if drop_null_score else reviews


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in columns})
