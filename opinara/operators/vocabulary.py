"""Corpus vocabulary with a deterministic cut."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def term_statistics(tokens: DataFrame, column: str = "tokens") -> DataFrame:
    """Occurrences and document frequency of every term.

    One pass: each text is unfolded into its tokens and its distinct tokens, and
    both are counted before the shuffle, so a term found in every text still sends
    one row per task.
    """
    halves = F.array(
        F.struct(F.col(column).alias("terms"), F.lit(False).alias("once")),
        F.struct(F.array_distinct(column).alias("terms"), F.lit(True).alias("once")),
    )
    return (
        tokens.select(F.inline(halves))
        .select("once", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.count_if(~F.col("once")).alias("term_count"), F.count_if("once").alias("doc_freq"))
    )


def vocabulary(tokens: DataFrame, min_df: int, size: int, column: str = "tokens") -> DataFrame:
    """The ``size`` most frequent terms found in at least ``min_df`` texts.

    Ties at the cut go to the smaller term, so every run keeps the same words.
    ``idx`` is the position of the term in a feature vector.
    """
    order = [F.desc("term_count"), F.asc("term")]
    top = term_statistics(tokens, column).filter(F.col("doc_freq") >= min_df).orderBy(*order).limit(size)
    # At most ``size`` rows reach this window.
    return top.withColumn("idx", F.row_number().over(Window.orderBy(*order)) - 1)
