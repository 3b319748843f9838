"""Does disappointment write more than satisfaction?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions import SCORE_BINS, Bins, first_match, rated, rounded, share

# Shortest mean positive text with a meaningful ratio, and the
# surplus of negative words from which a bucket is said to vent.
MIN_POSITIVE_WORDS = 3.0
VENTING_WORDS = 10.0


def length_asymmetry(reviews: DataFrame, bins: Bins = SCORE_BINS, drop_null_score: bool = False) -> DataFrame:
    """Per score bucket: mean word counts, share of reviews with text, difference and ratio."""
    buckets = rated(reviews, drop_null_score).groupBy(bins.id(F.col("score")).alias("bucket_id")).agg(
        F.avg("neg_words").alias("avg_neg_words"),
        F.avg("pos_words").alias("avg_pos_words"),
        share(F.col("neg_words") > 0).alias("pct_has_neg"),
        share(F.col("pos_words") > 0).alias("pct_has_pos"),
        F.count(F.lit(1)).alias("n"),
    )
    neg, pos = F.col("avg_neg_words"), F.col("avg_pos_words")
    compared = buckets.withColumns(
        {
            "bucket": bins.label(F.col("bucket_id")),
            "delta": neg - pos,
            "neg_pos_ratio": F.when(pos >= MIN_POSITIVE_WORDS, neg / pos),
        }
    )
    shown = rounded(compared, 2, "avg_neg_words", "avg_pos_words", "delta", "pct_has_neg", "pct_has_pos")
    return (
        rounded(shown, 3, "neg_pos_ratio")
        .select(
            "bucket_id",
            "bucket",
            "avg_neg_words",
            "avg_pos_words",
            "delta",
            "neg_pos_ratio",
            "pct_has_neg",
            "pct_has_pos",
            "n",
        )
        .orderBy("bucket_id")
    )


def length_long(asymmetry: DataFrame) -> DataFrame:
    """Chart form: one row per bucket and side."""
    sides = asymmetry.select(
        "bucket_id",
        "bucket",
        F.col("avg_pos_words").alias("positive"),
        F.col("avg_neg_words").alias("negative"),
    )
    return sides.unpivot(["bucket_id", "bucket"], ["positive", "negative"], "side", "mean_words")


def length_verdict(asymmetry: DataFrame) -> DataFrame:
    """The buckets leaning furthest to either side, and whether the first one vents."""
    known = asymmetry.filter(F.col("delta").isNotNull())
    ends = known.agg(
        F.min_by("bucket", F.struct((-F.col("delta")).alias("d"), "bucket_id")).alias("most_negative"),
        F.max("delta").alias("max_delta"),
        F.min_by("bucket", F.struct("delta", "bucket_id")).alias("most_positive"),
        F.min("delta").alias("min_delta"),
    )
    venting = F.col("max_delta") > VENTING_WORDS
    return ends.filter(F.col("max_delta").isNotNull()).withColumn(
        "verdict", first_match([(venting, "venting")], "balanced")
    )
