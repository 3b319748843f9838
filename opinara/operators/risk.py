"""Entities whose good reputation hides bad experiences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions import rated


def hidden_risk(
    reviews: DataFrame,
    min_count: int = 50,
    min_prior: float = 8.0,
    min_disaster_pct: float = 5.0,
    disaster_score: float = 4.0,
    top_k: int | None = None,
    drop_null_score: bool = False,
    continuous_scores: bool = False,
    accuracy: int = 10_000,
) -> DataFrame:
    """Entities with a high published score and a high share of disasters, riskiest first.

    The rounded disaster percentage feeds both the index and the filter.  The reviews are read once: they are counted by entity and
    score, and ``p05``, like all other figures, comes from these counts.  ``continuous_scores`` is for scores that hardly repeat, where
    counts would be as many as reviews: ``p05`` is then a mergeable quantile summary with rank error ``n / accuracy``.
    """
    disaster = F.col("score") <= disaster_score
    usable = rated(reviews, drop_null_score)
    if continuous_scores:
        entities = usable.groupBy("entity").agg(
            F.avg("prior_score").alias("avg_prior"),
            F.avg("score").alias("mean_score"),
            F.count(F.lit(1)).alias("n"),
            F.count_if(disaster).alias("disaster_count"),
            F.percentile_approx("score", 0.05, accuracy).alias("p05"),
        )
    else:
        counts = usable.groupBy("entity", "score").agg(
            F.count(F.lit(1)).alias("n_reviews"), F.count("prior_score").alias("n_prior"), F.sum("prior_score").alias("sum_prior")
        )
        rated_n = F.when(F.col("score").isNotNull(), F.col("n_reviews"))
        entities = (
            counts.withColumn("below", F.sum(rated_n).over(Window.partitionBy("entity").orderBy("score")))
            .withColumn("scored", F.sum(rated_n).over(Window.partitionBy("entity")))
            .groupBy("entity")
            .agg(
                F.try_divide(F.sum("sum_prior"), F.sum("n_prior")).alias("avg_prior"),
                F.try_divide(F.sum(F.col("score") * F.col("n_reviews")), F.sum(rated_n)).alias("mean_score"),
                F.sum("n_reviews").alias("n"),
                F.sum(F.when(disaster, F.col("n_reviews")).otherwise(0)).alias("disaster_count"),
                F.min(F.when(F.col("below") >= 0.05 * F.col("scored"), F.col("score"))).alias("p05"),
            )
        )
    scored = entities.withColumn("disaster_pct", F.round(F.col("disaster_count") / F.col("n") * 100, 2)).withColumn(
        "risk_index", F.round(F.col("disaster_pct") * F.log1p("n"), 2)
    )
    risky = scored.filter((F.col("n") >= min_count) & (F.col("avg_prior") >= min_prior) & (F.col("disaster_pct") >= min_disaster_pct))
    columns = ["entity", "avg_prior", "mean_score", "n", "disaster_count", "p05", "disaster_pct", "risk_index"]
    ordered = risky.select(*columns).orderBy(F.desc("risk_index"), F.desc("disaster_pct"), "entity")
    return ordered if top_k is None else ordered.limit(top_k)
