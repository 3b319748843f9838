"""What must hold of a fit whatever its data: figures that a model which learned nothing doesn't reach."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.plans.online_lda import TopicModel


def center_drift(assigned: DataFrame, model: KMeansModel, vector: str = "vector") -> DataFrame:
    """``cluster`` and ``drift``: how far its centre lies from the mean of its members, in the farthest feature.

    Centres are their members' means once k-means has settled.  A row for each cluster that has members.
    """
    centers = F.array(*[F.array(*[F.lit(float(x)) for x in center]) for center in model.clusterCenters()])
    means = (
        assigned.filter(F.col("cluster").isNotNull())
        .select("cluster", F.posexplode(vector_to_array(vector)).alias("feature", "value"))
        .groupBy("cluster", "feature")
        .agg(F.avg("value").alias("mean"))
    )
    center = F.element_at(F.element_at(centers, F.col("cluster") + 1), F.col("feature") + 1)
    return means.groupBy("cluster").agg(F.max(F.abs(F.col("mean") - center)).alias("drift"))


def _weighed_sum(vectors: DataFrame, weight: str) -> np.ndarray:
    """Sum over rows of weight times vector (``features``)."""
    mean: Vector = vectors.select(Summarizer.mean(F.col("features"), F.col(weight)).alias("mean")).first()["mean"]
    return mean.toArray() * vectors.agg(F.sum(weight)).first()[0]


def slope_left(train: DataFrame, model: PipelineModel) -> float:
    """Length of the logistic loss's slope with its penalty at the fit, as a share of that at the best constant.

    0 at the optimum, 1 for a model that learned nothing.  ``train`` has ``label`` and the ``counts`` that the last two stages of the
    model, word weights and classifier, take.  The slope is that of standardised features, which the penalty weighs alike.
    """
    weights, classifier = model.stages[-2], model.stages[-1]
    assert isinstance(classifier, LogisticRegressionModel)
    scored = classifier.transform(weights.transform(train)).select("features", "label", vector_to_array("probability")[1].alias("chance"))
    spread = scored.select(Summarizer.metrics("std", "count").summary(F.col("features")).alias("s")).select("s.*").first()
    std, n = spread["std"].toArray(), spread["count"]
    with np.errstate(divide="ignore"):
        scale = np.where(std > 0, 1 / std, 0.0)
    positive, predicted = _weighed_sum(scored, "label") / n, _weighed_sum(scored, "chance") / n
    every = _weighed_sum(scored.withColumn("one", F.lit(1.0)), "one") / n
    share = scored.agg(F.avg("label")).first()[0]
    fitted = (predicted - positive) * scale + classifier.getRegParam() * classifier.coefficients.toArray() * std
    constant = (share * every - positive) * scale
    return float(np.linalg.norm(fitted) / max(float(np.linalg.norm(constant)), 1e-300))


def one_topic_perplexity(term_counts: Sequence[int]) -> float:
    """Log perplexity per word of the model that has a single topic: the words' own frequencies."""
    total = sum(term_counts)
    return -sum(n / total * math.log(n / total) for n in term_counts if n)


def topic_weight_error(model: TopicModel) -> float:
    """How far the weights of a topic's whole vocabulary are from adding up to 1, at most."""
    sums = model.describeTopics(model.counts.shape[1]).select(F.aggregate("termWeights", F.lit(0.0), lambda s, w: s + w).alias("sum"))
    return sums.agg(F.max(F.abs(F.col("sum") - 1))).first()[0]
