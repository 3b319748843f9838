"""How severely each reviewer segment scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions import rated, rounded, score_stats


def segment_severity(reviews: DataFrame, min_count: int = 100, drop_null_score: bool = False) -> DataFrame:
    """Score statistics of segments with *more than* ``min_count`` reviews, severest first."""
    stats = score_stats(
        rated(reviews, drop_null_score),
        F.trim("segment").alias("segment"),
        extra=(F.min("score").alias("min_score"), F.max("score").alias("max_score")),
    )
    kept = stats.filter(F.col("n") > min_count)
    return rounded(kept, 3, "mean_score", "std_score").orderBy("mean_score", "segment")


def segment_summary(severity: DataFrame) -> DataFrame:
    """Number of segments, mean of their deviations, and spread of their means."""
    return severity.agg(
        F.count(F.lit(1)).alias("n_segments"),
        F.round(F.avg("std_score"), 6).alias("mean_std"),
        F.round(F.max("mean_score") - F.min("mean_score"), 3).alias("mean_range"),
    )


def _ranked_end(severity: DataFrame, side: str, k: int) -> DataFrame:
    mean = F.col("mean_score")
    order = [mean.desc_nulls_last() if side == "generous" else mean.asc_nulls_last(), F.col("segment")]
    # The window sees the k rows the limit let through, never the whole table.
    return (
        severity.orderBy(*order)
        .limit(k)
        .select(
            F.lit(side).alias("side"),
            F.row_number().over(Window.orderBy(*order)).alias("rank"),
            "segment",
            "mean_score",
            "n",
        )
    )


def segment_extremes(severity: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most generous and the ``k`` most critical segments, ranked."""
    return _ranked_end(severity, "generous", k).unionByName(_ranked_end(severity, "critical", k))


def segment_chart(severity: DataFrame, k: int = 15) -> DataFrame:
    """Both ends, severest first, labelled ``segment (n)``.

    With fewer than ``2k`` segments the ends overlap and a segment shows twice.
    """
    return (
        segment_extremes(severity, k)
        .select(
            "side",
            "rank",
            F.concat("segment", F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("label"),
            "mean_score",
        )
        .orderBy("mean_score", "label", "side")
    )
