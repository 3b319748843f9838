"""CSV of hotel reviews, read as text, so no pass is spent on inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.operators.cleaning import MALFORMED, CleaningRules, clean_reviews
from opinara.roles import HOTEL_CSV, as_reviews
from opinara.sources.csv_records import WRONG_FIELDS, read_records

# Header of the public European hotel review CSV, in file order.
_HEADER = (
    "Hotel_Address",
    "Additional_Number_of_Scoring",
    "Review_Date",
    "Average_Score",
    "Hotel_Name",
    "Reviewer_Nationality",
    "Negative_Review",
    "Review_Total_Negative_Word_Counts",
    "Total_Number_of_Reviews",
    "Positive_Review",
    "Review_Total_Positive_Word_Counts",
    "Total_Number_of_Reviews_Reviewer_Has_Given",
    "Reviewer_Score",
    "Tags",
    "days_since_review",
    "lat",
    "lng",
)

#: Every field is read as text; cleaning gives the types and counts what it cannot repair.
RAW_CSV_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in _HEADER])

CSV_RULES = CleaningRules(integers=("total_reviews", "neg_words", "pos_words"))


_CORRUPT = "_corrupt_record"

#: Roles a file must have a column for; the others are used when they are there.
NEEDED = ("entity", "event_date", "neg_text", "pos_text", "lat", "lng", "prior_score", "score")


def read_raw_hotel_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, line_breaks: bool = False, **options: str
) -> DataFrame:
    """Raw reviews under role names, and ``malformed``, what is wrong with a line, for the cleaning to count.

    The header names the columns, in any order and with others among them, and all are read as text; that takes a look at
    the first line and no pass over the file.  Missing columns of ``NEEDED`` are an error, other roles' columns come back null.

    A line is a record; Spark wants another column read beside ``malformed``.  With ``line_breaks`` a quoted text may go on over several lines (``csv_records``), which costs a second reading of the
    file and options other than those of quoting and parsing.  With a ``schema`` Spark checks it against the header instead, and nothing is marked.
    """
    settings = {"header": "true", "enforceSchema": "false", **options}
    if schema is not None:
        return as_reviews(spark.read.schema(schema).options(**settings).csv(path), HOTEL_CSV)
    names = spark.read.options(**settings).csv(path).columns
    absent = {role: name for role, name in HOTEL_CSV.items() if name not in names}
    if needed := sorted(absent[role] for role in NEEDED if role in absent):
        raise ValueError(f"columns missing in {path}: {needed}")
    if line_breaks:
        rows = read_records(spark, path, names, header=spark.read.text(path).first()["value"], **options)
    else:
        text = T.StructType([T.StructField(name, T.StringType()) for name in (*names, _CORRUPT)])
        rows = spark.read.schema(text).options(columnNameOfCorruptRecord=_CORRUPT, columnPruning="false", **settings).csv(path)
        rows = rows.withColumn(MALFORMED, F.when(F.col(_CORRUPT).isNotNull(), WRONG_FIELDS)).drop(_CORRUPT)
    return as_reviews(rows.withColumns({name: F.lit(None).cast("string") for name in absent.values()}), HOTEL_CSV)


def read_hotel_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    rules: CleaningRules = CSV_RULES,
    line_breaks: bool = False,
    **options: str,
) -> DataFrame:
    """Cleaned reviews, ready for every operator."""
    return clean_reviews(read_raw_hotel_csv(spark, path, schema, line_breaks, **options), rules)
