"""Repair the types of a raw review table and drop unusable rows, saying why."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import first_match

KEPT = "kept"
#: A column that a source may add: null, or what is wrong with the line a row was read from.
MALFORMED = "malformed"


@dataclass(frozen=True)
class CleaningRules:
    """What a usable review needs.

    ``na_text_stays`` keeps a row whose required text is exactly the NA token (it
    becomes null instead); by default such a row is dropped like any missing text.
    """

    required_text: tuple[str, ...] = ("entity", "event_date", "neg_text", "pos_text")
    doubles: tuple[str, ...] = ("lat", "lng", "prior_score", "score")
    integers: tuple[str, ...] = ("total_reviews",)
    required_numbers: tuple[str, ...] = ("lat", "lng", "prior_score")
    na_token: str = "NA"
    na_text_stays: bool = False


def _or_null(df: DataFrame, name: str, token: str) -> Column:
    """The column with the NA token as null; non-text columns are left alone."""
    if dict(df.dtypes)[name] != "string":
        return F.col(name)
    return F.nullif(F.col(name), F.lit(token))


def judge_reviews(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Typed rows plus ``outcome``: ``kept`` or the first rule the row breaks.

    Of a table with a column ``malformed``, rows of lines that could not be read come first: "malformed" and what is wrong.
    """
    types = dict(raw.dtypes)

    def missing(name: str) -> Column:
        value = F.col(name)
        if types[name] != "string":
            return value.isNull()
        # one test that reads the value once: Spark puts its whole expression wherever a filter names it
        return F.coalesce(value, F.lit("")).isin([""] if rules.na_text_stays else ["", rules.na_token])

    text_rules = [(missing(name), f"missing {name}") for name in rules.required_text]
    if MALFORMED in types:
        text_rules.insert(0, (F.col(MALFORMED).isNotNull(), F.concat(F.lit(f"{MALFORMED}: "), MALFORMED)))
    judged = raw.withColumn("outcome", first_match(text_rules, None)).drop(MALFORMED)

    repaired = {name: _or_null(raw, name, rules.na_token) for name, kind in raw.dtypes if kind == "string" and name != MALFORMED}
    for name in rules.doubles:
        number = _or_null(raw, name, rules.na_token).try_cast("double")
        repaired[name] = F.when(F.abs(number) < float("inf"), number)  # NaN counts as larger: neither is a number to average
    for name in rules.integers:
        repaired[name] = _or_null(raw, name, rules.na_token).try_cast("double").try_cast("int")
    typed = judged.withColumns(repaired)

    number_rules = [
        (F.col(name).isNull(), f"unusable {name}") for name in rules.required_numbers
    ]
    return typed.withColumn("outcome", F.coalesce("outcome", first_match(number_rules, KEPT)))


def clean_reviews(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Usable reviews with declared types; one narrow pass, no shuffle."""
    return judge_reviews(raw, rules).filter(F.col("outcome") == KEPT).drop("outcome")


def cleaning_report(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Rows per outcome, from the same single pass."""
    return judge_reviews(raw, rules).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
