"""What a complaint keyword does to the score."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opinara.functions import ci95, first_match, hash_order, rated, rounded, score_stats
from opinara.functions.text import first_word, whole_word

# Words that tell of building works.
BUILDING_WORKS = (
    "construction",
    "renovation",
    "renovating",
    "works",
    "drilling",
    "hammering",
    "building work",
    "jackhammer",
)
# Fixed value: the difference taken for an effect when no interval is known.
PLAIN_EFFECT = 0.3


def _has_keyword(words: Sequence[str]) -> Column:
    return F.col("neg_text").rlike(whole_word(words))


def keyword_impact(
    reviews: DataFrame, words: Sequence[str] = BUILDING_WORKS, drop_null_score: bool = False
) -> DataFrame:
    """Score statistics of reviews with and without the keyword.

    Reviews without negative text form a third group whose flag is null.
    """
    stats = score_stats(rated(reviews, drop_null_score), _has_keyword(words).alias("has_keyword"))
    with_ci = stats.withColumn("ci95", ci95(F.col("std_score"), F.col("n")))
    return rounded(with_ci, 3, "mean_score", "std_score", "ci95").orderBy("has_keyword")


def _first_keyword(words: Sequence[str], keep_case: bool) -> Column:
    """The first keyword of the negative text, null where there is none."""
    found = first_word(F.col("neg_text"), words)
    return found if keep_case else F.lower(found)


def keyword_frequency(
    reviews: DataFrame,
    words: Sequence[str] = BUILDING_WORKS,
    keep_case: bool = False,
    top_k: int | None = None,
) -> DataFrame:
    """Reviews per first matched keyword, most frequent first.

    ``keep_case`` counts "Works" and "works" apart.  Reviews without a keyword
    fall into a null group of count zero, dropped after the aggregate: a filter
    before it would search every text twice.
    """
    counts = (
        reviews.withColumn("keyword", _first_keyword(words, keep_case))
        .groupBy("keyword")
        .agg(F.count("keyword").alias("n"))
        .filter(F.col("n") > 0)
        .orderBy(F.desc("n"), "keyword")
    )
    return counts if top_k is None else counts.limit(top_k)


def keyword_samples(
    reviews: DataFrame,
    words: Sequence[str] = BUILDING_WORKS,
    n: int = 5,
    seed: int = 42,
    keep_case: bool = False,
    keys: Sequence[str] = (),
) -> DataFrame:
    """``n`` pseudo-random hits; the same rows on every run and every cluster.

    ``keys`` should name a review, so that equal reviews draw numbers of their own; they are shown too.
    Only hits draw a number, so they come first in the per-task top ``n``.
    """
    source = (*keys, "entity", "score", "neg_text")
    drawn = reviews.select(*source, _first_keyword(words, keep_case).alias("keyword")).withColumn(
        "draw", F.when(F.col("keyword").isNotNull(), hash_order(*source, seed=seed))
    )
    first = drawn.orderBy(F.col("draw").asc_nulls_last(), *source, "keyword").limit(n)
    return first.filter(F.col("draw").isNotNull()).drop("draw")


def keyword_verdict(impact: DataFrame) -> DataFrame:
    """One row judging the effect, with both sides' reviews (if ``impact`` counts them), means and intervals; empty when one side has no mean."""
    sides_of = {"hit": F.col("has_keyword"), "other": ~F.col("has_keyword")}
    shown = {"n": "n", "mean_score": "mean", "ci95": "ci"}
    figures = [(name, side) for name in shown if name in impact.columns for side in sides_of]
    sides = impact.agg(*[F.max(F.when(sides_of[side], F.col(name))).alias(f"{shown[name]}_{side}") for name, side in figures])
    diff = F.col("diff")
    strong = F.coalesce("threshold", F.lit(PLAIN_EFFECT))
    return (
        sides.withColumns(
            {"diff": F.round(F.col("mean_hit") - F.col("mean_other"), 3), "threshold": F.round(F.col("ci_hit") + F.col("ci_other"), 3)}
        )
        .filter(diff.isNotNull())
        .withColumn("verdict", first_match([(diff < -strong, "strong"), (diff < 0, "mild")], "none"))
    )


def keyword_summary(reviews: DataFrame, words: Sequence[str] = BUILDING_WORKS, keep_case: bool = False) -> DataFrame:
    """Impact, frequency and verdict of one list of words in a single pass over the texts.

    A row per flag and first keyword: ``n_keyword`` reviews with it, then the figures of all reviews with that flag
    as in ``keyword_impact``, and the means, difference, threshold and verdict of the whole, as in ``keyword_verdict`` (nulls
    where a side has no mean).  Reviews without a keyword have a null one; those without text a null flag too.

    The texts are reduced to counts, means and squared deviations per keyword, which merge; the windows see that table only.
    """
    per_keyword = (
        reviews.withColumn("keyword", _first_keyword(words, keep_case))
        .withColumn("has_keyword", F.when(F.col("neg_text").isNotNull(), F.col("keyword").isNotNull()))
        .groupBy("has_keyword", "keyword")
        .agg(
            F.count(F.lit(1)).alias("n_keyword"),
            F.count("score").alias("n_score"),
            F.avg("score").alias("mean"),
            (F.var_pop("score") * F.count("score")).alias("m2"),
        )
    )
    flag, whole = W.partitionBy("has_keyword"), W.partitionBy(F.lit(1))
    n_score = F.sum("n_score").over(flag)
    merged = per_keyword.withColumn("n", F.sum("n_keyword").over(flag)).withColumn(
        "mean_flag", F.sum(F.col("mean") * F.col("n_score")).over(flag) / F.nullif(n_score, F.lit(0))
    )
    spread = F.sum(F.col("m2") + F.col("n_score") * F.pow(F.col("mean") - F.col("mean_flag"), 2)).over(flag)
    std = F.when(n_score > 1, F.sqrt(spread / (n_score - 1)))
    flags = merged.withColumn("std_flag", std).select(
        "has_keyword",
        "keyword",
        "n_keyword",
        "n",
        F.round("mean_flag", 3).alias("mean_score"),
        F.round("std_flag", 3).alias("std_score"),
        F.round(ci95(F.col("std_flag"), F.col("n")), 3).alias("ci95"),
    )

    def side(name: str, hit: bool) -> Column:
        return F.max(F.when(F.col("has_keyword") == hit, F.col(name))).over(whole)

    judged = (
        flags.withColumn("mean_hit", side("mean_score", True))
        .withColumn("mean_other", side("mean_score", False))
        .withColumn("diff", F.round(F.col("mean_hit") - F.col("mean_other"), 3))
        .withColumn("threshold", F.round(side("ci95", True) + side("ci95", False), 3))
    )
    diff, strong = F.col("diff"), F.coalesce("threshold", F.lit(PLAIN_EFFECT))
    verdict = first_match([(diff < -strong, "strong"), (diff < 0, "mild")], "none")
    return judged.withColumn("verdict", F.when(diff.isNotNull(), verdict)).orderBy("has_keyword", F.desc("n_keyword"), "keyword")


@dataclass(frozen=True)
class KeywordReport:
    impact: DataFrame
    frequency: DataFrame
    samples: DataFrame
    verdict: DataFrame


def keyword_report(
    reviews: DataFrame, words: Sequence[str] = BUILDING_WORKS, sample_size: int = 5, keys: Sequence[str] = ()
) -> KeywordReport:
    """All keyword tables of one list of words.

    They are separate plans over ``reviews``; ``keyword_summary`` has all but the samples in one pass.
    """
    impact = keyword_impact(reviews, words)
    return KeywordReport(
        impact,
        keyword_frequency(reviews, words),
        keyword_samples(reviews, words, sample_size, keys=keys),
        keyword_verdict(impact),
    )
