"""Satisfaction per traveller type, read off the trip tags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import ci95, first_match, rated, rounded, score_stats

# Tag fragments in order of precedence.  "family" also matches a
# room type, so a couple in a family room counts as a family.
TRAVELLER_TAGS = (
    ("solo traveler", "Solo"),
    ("family", "Family"),
    ("group", "Group"),
    ("couple", "Couple"),
)
OTHER = "Other"


def traveller_type(tags: Column, fragments: Sequence[tuple[str, str]] = TRAVELLER_TAGS) -> Column:
    lowered = F.lower(tags)
    return first_match([(lowered.contains(part), label) for part, label in fragments], OTHER)


def traveller_satisfaction(
    reviews: DataFrame,
    min_count: int = 50,
    fragments: Sequence[tuple[str, str]] = TRAVELLER_TAGS,
    drop_null_score: bool = False,
) -> DataFrame:
    """Score statistics of types with *more than* ``min_count`` reviews, happiest first."""
    stats = score_stats(rated(reviews, drop_null_score), traveller_type(F.col("tags"), fragments).alias("traveller"))
    kept = stats.filter(F.col("n") > min_count).withColumn("ci95", ci95(F.col("std_score"), F.col("n")))
    return rounded(kept, 3, "mean_score", "std_score", "ci95").orderBy(
        F.desc("mean_score"), "traveller"
    )


def traveller_best_worst(satisfaction: DataFrame) -> DataFrame:
    """The most and the least satisfied type; ties go to the first name."""
    mean = F.col("mean_score")
    best_first = F.struct((-mean).alias("mean"), "traveller")
    worst_first = F.struct(mean, "traveller")
    return (
        satisfaction.filter(mean.isNotNull())
        .agg(
            F.min_by("traveller", best_first).alias("best"),
            F.max("mean_score").alias("best_score"),
            F.min_by("traveller", worst_first).alias("worst"),
            F.min("mean_score").alias("worst_score"),
        )
        .filter(F.col("best").isNotNull())
    )
