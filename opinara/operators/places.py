"""Entities as points on a map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions import in_fraction


def map_points(
    reviews: DataFrame, min_count: int = 50, fraction: float = 1.0, seed: int = 42
) -> DataFrame:
    """One point per entity with at least ``min_count`` reviews.

    ``fraction`` thins the map by a hash of the entity name, so the same entities
    stay whatever the partitioning.
    """
    points = (
        reviews.groupBy("entity", "lat", "lng")
        .agg(F.avg("score").alias("mean_score"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_count)
    )
    if fraction < 1.0:
        points = points.filter(in_fraction("entity", fraction=fraction, seed=seed))
    return points


def map_summary(points: DataFrame) -> DataFrame:
    """Points shown, unweighted mean of their means, and reviews behind them."""
    return points.agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.round(F.avg("mean_score"), 6).alias("mean_of_means"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_reviews"),
    )


def map_top(points: DataFrame, n: int = 5) -> DataFrame:
    """The best scored points."""
    return (
        points.select("entity", "mean_score", "n")
        .orderBy(F.col("mean_score").desc_nulls_last(), F.desc("n"), "entity")
        .limit(n)
    )
