"""How far an entity's mean score can be trusted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions import rated, rounded, score_stats


def score_reliability(
    reviews: DataFrame, min_count: int = 100, top_k: int | None = None, drop_null_score: bool = False
) -> DataFrame:
    """Dispersion per entity with at least ``min_count`` reviews, most disputed first.

    ``cv`` divides the unrounded deviation by the unrounded mean.
    """
    stats = score_stats(
        rated(reviews, drop_null_score), "entity", extra=(F.avg("prior_score").alias("avg_prior"),)
    )
    kept = stats.filter(F.col("n") >= min_count).withColumn(
        "cv", F.round(F.try_divide("std_score", "mean_score"), 4)
    )
    ordered = (
        rounded(kept, 2, "avg_prior", "mean_score", "std_score")
        .select("entity", "avg_prior", "mean_score", "std_score", "n", "cv")
        .orderBy(F.desc("std_score"), "entity")
    )
    return ordered if top_k is None else ordered.limit(top_k)
