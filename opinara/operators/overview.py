"""First look at a review table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREVIEW_COLUMNS = ("entity", "score", "segment", "pos_text", "neg_text")


def dataset_overview(reviews: DataFrame) -> DataFrame:
    """Reviews, mean published score over reviews, and distinct entities, in one job."""
    return reviews.agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.avg("prior_score").alias("avg_prior"),
        F.count_distinct("entity").alias("n_entities"),
    )


def review_preview(
    reviews: DataFrame,
    columns: Sequence[str] | None = PREVIEW_COLUMNS,
    n: int = 200,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """``n`` rows of the shown columns; ``columns=None`` shows all.

    Without ``order`` any rows, which reads no more than it shows.  ``order`` takes the first rows by these columns, each
    task keeping its own first ``n``: name narrow columns, and attach texts to the result.
    """
    rows = reviews.orderBy(*order).limit(n) if order else reviews.limit(n)
    return rows.select(*columns) if columns else rows
