"""Column roles of a review table and the mapping from a source's own names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

#: What each role means.  An operator needs only the roles it reads.
ROLES = {
    "entity": "the thing reviewed",
    "event_date": "date of the review",
    "neg_text": "what the reviewer disliked",
    "pos_text": "what the reviewer liked",
    "lat": "latitude of the entity",
    "lng": "longitude of the entity",
    "prior_score": "published score of the entity, the expectation",
    "total_reviews": "published number of reviews of the entity",
    "score": "score given by this review, may be null",
    "segment": "reviewer group, for instance nationality",
    "tags": "free text describing the trip",
    "neg_words": "word count of neg_text",
    "pos_words": "word count of pos_text",
}

# Column names of the public European hotel review CSV.
HOTEL_CSV = {
    "entity": "Hotel_Name",
    "event_date": "Review_Date",
    "neg_text": "Negative_Review",
    "pos_text": "Positive_Review",
    "lat": "lat",
    "lng": "lng",
    "prior_score": "Average_Score",
    "total_reviews": "Total_Number_of_Reviews",
    "score": "Reviewer_Score",
    "segment": "Reviewer_Nationality",
    "tags": "Tags",
    "neg_words": "Review_Total_Negative_Word_Counts",
    "pos_words": "Review_Total_Positive_Word_Counts",
}


def as_reviews(df: DataFrame, names: Mapping[str, str] = HOTEL_CSV) -> DataFrame:
    """Rename source columns to their roles; columns without a role are carried through."""
    unknown = set(names) - set(ROLES)
    if unknown:
        raise ValueError(f"not a role: {sorted(unknown)}")
    return df.withColumnsRenamed({source: role for role, source in names.items() if source != role})
