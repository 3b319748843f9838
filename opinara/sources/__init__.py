"""Where review tables come from."""

from opinara.sources.csv import RAW_CSV_SCHEMA, read_hotel_csv
from opinara.sources.star import document_reviews, raw_reviews, reviews

__all__ = ["RAW_CSV_SCHEMA", "document_reviews", "raw_reviews", "read_hotel_csv", "reviews"]
