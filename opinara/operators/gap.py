"""Given score against published score, per prestige band."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions import PRESTIGE_BINS, Bins, first_match, rated, rounded, share

# Fixed value: difference of shortfalls from which one band counts as harsher.
HARSHER_BY = 0.30


def expectation_gap(
    reviews: DataFrame, min_count: int = 0, bins: Bins = PRESTIGE_BINS, drop_null_score: bool = False
) -> DataFrame:
    """Per prestige band: mean gap, share of reviews below expectation, mean shortfall."""
    gap = F.col("score") - F.col("prior_score")
    bands = rated(reviews, drop_null_score).groupBy(bins.id(F.col("prior_score")).alias("bucket_id")).agg(
        F.avg(gap).alias("avg_gap"),
        share(gap < 0).alias("pct_below"),
        F.coalesce(F.avg(F.when(gap < 0, gap)), F.lit(0.0)).alias("mean_shortfall"),
        F.count(F.lit(1)).alias("n"),
    )
    kept = rounded(bands.filter(F.col("n") >= min_count), 3, "avg_gap", "mean_shortfall")
    return (
        rounded(kept, 2, "pct_below")
        .select(
            "bucket_id",
            bins.label(F.col("bucket_id")).alias("bucket"),
            "avg_gap",
            "pct_below",
            "mean_shortfall",
            "n",
        )
        .orderBy("bucket_id")
    )


def gap_verdict(gaps: DataFrame) -> DataFrame:
    """The bands with the deepest and the shallowest shortfall; empty for empty input."""
    shortfall = F.col("mean_shortfall")
    ends = gaps.agg(
        F.min_by("bucket", F.struct(shortfall, "bucket_id")).alias("harshest"),
        F.abs(F.min(shortfall)).alias("harshest_shortfall"),
        F.min_by("bucket", F.struct((-shortfall).alias("s"), "bucket_id")).alias("mildest"),
        F.abs(F.max(shortfall)).alias("mildest_shortfall"),
    ).filter(F.col("harshest").isNotNull())
    diff = F.round(F.col("harshest_shortfall") - F.col("mildest_shortfall"), 3)
    return ends.withColumn("diff", diff).withColumn(
        "verdict", first_match([(F.col("diff") >= HARSHER_BY, "more intense")], "similar")
    )
