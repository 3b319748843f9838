"""Entity features for profiling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions import share
from opinara.functions.text import any_part, mentions

# Complaint themes searched in negative texts (no word boundary).
COMPLAINT_THEMES = {
    "construction": ("construction", "renovation", "works", "noise"),
    "cleanliness": ("dirty", "clean", "hygiene"),
    "staff": ("staff", "service", "reception", "rude"),
}

Themes = Mapping[str, Sequence[str]]


def theme_columns(themes: Themes = COMPLAINT_THEMES) -> list[str]:
    return [f"pct_{theme}" for theme in themes]


def feature_columns(themes: Themes = COMPLAINT_THEMES) -> list[str]:
    """Features in vector order; coordinates are not among them."""
    return [
        "mean_score",
        "n_scores",
        "pct_excellent",
        "pct_negative",
        "pos_neg_ratio",
        "mean_length",
        "n_segments",
        *theme_columns(themes),
    ]


def entity_features(
    reviews: DataFrame,
    themes: Themes = COMPLAINT_THEMES,
    approximate_segments: bool = False,
) -> DataFrame:
    """Ten features per (entity, lat, lng) in one pass over the reviews.

    The distinct count shuffles one pre-aggregated row per (entity, segment) and
    task; ``approximate_segments`` replaces it by a sketch for very many segments.
    """
    pos, neg = F.length("pos_text"), F.length("neg_text")
    score = F.col("score")
    distinct = F.approx_count_distinct if approximate_segments else F.count_distinct
    return reviews.groupBy("entity", "lat", "lng").agg(
        F.avg(score).alias("mean_score"),
        F.count(score).alias("n_scores"),
        share(score >= 9).alias("pct_excellent"),
        share(score < 6).alias("pct_negative"),
        (F.avg(pos) / (F.avg(neg) + 1)).alias("pos_neg_ratio"),
        F.avg(pos + neg).alias("mean_length"),
        distinct(F.col("segment")).alias("n_segments"),
        *(
            share(mentions(F.col("neg_text"), words, any_part(words))).alias(name)
            for name, words in zip(theme_columns(themes), themes.values())
        ),
    )
