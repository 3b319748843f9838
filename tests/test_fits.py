"""Mini-batches, layouts, lifetimes and what must hold of fits."""

from __future__ import annotations

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import functions as F

from checks import registry
from opinara.operators.features import feature_columns
from opinara.plans import diagnostics, durable, online_lda, profiling, sentiment, topics
from tests.test_topics import counted, planted


# --- layout -------------------------------------------------------------------


def test_partitions_follow_the_rows():
    assert [durable.partitions_for(n) for n in (0, 1, 10_000, 100_000, 9_000_000)] == [1, 1, 8, 26, 250]
    sizes = [durable.partitions_for(10**n) for n in range(3, 12)]
    assert all(a < b for a, b in zip(sizes, sizes[1:]))


def _parts(df):
    return df.select(F.spark_partition_id()).distinct().count()


def test_ten_times_the_rows_take_more_tasks(spark):
    small, large = (durable.durable(spark.range(n), "id") for n in (3_000, 30_000))
    assert _parts(small) < _parts(large)


def test_copies_of_a_text_spread(spark):
    copies = spark.range(20_000).select("id", F.lit("the same text").alias("text"))
    keyed = copies.select(F.xxhash64("text", "id").alias("row"), "id")
    assert _parts(durable.durable(keyed, "row")) > 5


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_layout_depends_on_the_rows_alone(spark, partitions):
    df = spark.range(5_000).withColumn("x", F.col("id") * 7 % 1000)
    laid = durable.durable(df.repartition(partitions), "id").select("id", F.spark_partition_id().alias("p"))
    assert sorted(laid.collect()) == sorted(durable.durable(df, "id").select("id", F.spark_partition_id().alias("p")).collect())


# --- mini-batches -------------------------------------------------------------


@pytest.fixture(params=["folder", "memory"])
def either_store(request, monkeypatch):
    if request.param == "memory":
        monkeypatch.setattr(durable, "shared_folder", lambda df: None)
    return request.param


def _dealt(spark, n=2_000, batches=7):
    rows = spark.range(n).select("id", online_lda.batch_of(F.col("id"), batches).alias("batch"), (F.col("id") % 11).alias("payload"))
    return durable.in_batches(rows, "batch", batches, F.col("id"))


def test_every_row_is_in_one_batch(spark, either_store):
    kept, n = _dealt(spark)
    assert n == 2_000
    by_batch = [kept.where(F.col("batch") == b).select("id", "payload").collect() for b in range(7)]
    assert all(by_batch)
    assert sorted(r.id for rows in by_batch for r in rows) == list(range(2_000))
    assert all(r.payload == r.id % 11 for rows in by_batch for r in rows)
    durable.release(kept)


def test_a_batch_reads_its_own_files_only(spark):
    kept, _ = _dealt(spark)
    plan = kept.where(F.col("batch") == 3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan
    assert all("batch=3" in f for f in kept.where(F.col("batch") == 3).select(F.input_file_name().alias("f")).distinct().toPandas()["f"])


def test_an_epoch_reads_every_text_once(spark, monkeypatch):
    """The texts that the steps of an epoch meet, counted by the numbers that come back from the tasks."""
    steps = []
    real = online_lda._expected

    def counting(batch, *args):
        n, expected = real(batch, *args)
        steps.append((sorted(r.key for r in batch.select("key").collect()), n))
        return n, expected

    monkeypatch.setattr(online_lda, "_expected", counting)
    topics.fit_topics(planted(spark, 200), k=2, min_df=5, evaluate_stability=True, batches=6, epochs=2, row_keys=("id",))
    met = [key for keys, _ in steps for key in keys]
    assert len(met) == 400 and len(set(met)) == 200
    assert len(steps) == 12 and [n for _, n in steps] == [len(keys) for keys, _ in steps]
    assert sorted(met[:200]) == sorted(met[200:]) == sorted(set(met))


def test_copies_of_a_text_are_in_several_batches(spark):
    batches = spark.range(100).select(online_lda.batch_of(F.xxhash64(F.lit("same"), "id"), 20).alias("b"))
    assert batches.distinct().count() > 10


# --- inference ----------------------------------------------------------------


def test_digamma_is_the_slope_of_log_gamma():
    x = np.array([0.05, 0.3, 1.0, 2.5, 7.0, 100.0, 1e6])
    h = 1e-5 * x
    slope = (online_lda._lgamma(x + h) - online_lda._lgamma(x - h)) / (2 * h)
    assert online_lda.digamma(x) == pytest.approx(slope, rel=1e-5, abs=1e-5)
    assert online_lda.digamma(np.array([1.0]))[0] == pytest.approx(-0.5772156649015329, abs=1e-10)


def _one_text(words, counts, weight, alpha):
    """Plain loop over one text."""
    k = len(weight)
    gamma = [alpha + sum(counts) / k] * k
    psi = lambda x: float(online_lda.digamma(np.array([x]))[0])

    def share(w):
        parts = [math.exp(psi(g) - psi(sum(gamma))) * weight[t][w] for t, g in enumerate(gamma)]
        return [p / sum(parts) for p in parts]

    for _ in range(online_lda.ROUNDS):
        new = [alpha] * k
        for w, n in zip(words, counts):
            for t, p in enumerate(share(w)):
                new[t] += n * p
        change = sum(abs(a - b) for a, b in zip(new, gamma)) / k
        gamma = new
        if change < online_lda.SETTLED:
            break
    return gamma


def test_inference_equals_a_plain_loop_and_ignores_neighbours():
    rng = np.random.default_rng(3)
    weight = rng.random((3, 12)) + 0.01
    docs = [(rng.choice(12, n, replace=False), rng.integers(1, 5, n).astype(float)) for n in (5, 1, 12, 3)] + [(np.zeros(0, int), np.zeros(0))]
    texts = online_lda.Texts(len(docs), np.repeat(range(len(docs)), [len(w) for w, _ in docs]), np.concatenate([w for w, _ in docs]).astype(int), np.concatenate([n for _, n in docs]))
    together, _ = online_lda.infer(texts, weight, 1 / 3)
    for i, (words, counts) in enumerate(docs):
        assert together[i] == pytest.approx(_one_text(words, counts, weight.tolist(), 1 / 3), rel=1e-9)
        alone, _ = online_lda.infer(online_lda.Texts(1, np.zeros(len(words), int), words.astype(int), counts), weight, 1 / 3)
        assert (alone[0] == together[i]).all()


def test_topic_shares_of_a_text(spark):
    fitted = topics.fit_topics(planted(spark), k=2, min_df=5, evaluate_stability=False)
    rows = fitted.model.transform(counted(planted(spark, 20), fitted.vocabulary)).select("id", "topicDistribution").collect()
    assert all(sum(r.topicDistribution) == pytest.approx(1.0) for r in rows)
    assert len({(r.id % 2, r.topicDistribution[0] > 0.5) for r in rows}) == 2  # each kind has its own topic


def test_models_are_equal_to_the_last_bit_on_any_layout(spark):
    def model(df):
        return topics.fit_topics(df, k=2, min_df=5, evaluate_stability=False, row_keys=("id",)).model.counts

    expected = model(planted(spark))
    for df in (planted(spark).repartition(1), planted(spark).repartition(13, "id"), planted(spark).orderBy(F.desc("id"))):
        assert (model(df) == expected).all()


# --- what must hold of fits ---------------------------------------------------


def _checks(df, *names):
    return [tuple(r) for r in df.select(*names).distinct().collect()]


def test_random_topics_turn_the_check_red(spark):
    fitted = topics.fit_topics(planted(spark), k=2, min_df=5, evaluate_stability=False)
    words = [18 * 300 // 12] * 12
    names = ("better_than_one_topic", "weights_add_up", "perplexity_agrees")
    assert _checks(registry.checked_topics(fitted, words), *names) == [(True, True, True)]
    noise = online_lda.TopicModel(np.random.default_rng(1).gamma(0.1, 1.0, (2, 12)) + 1e-3, 0.5, 0.5)
    vectors = counted(planted(spark), fitted.vocabulary)
    likelihood = noise.logLikelihood(vectors)
    red = replace(fitted, model=noise, fit=topics._fit_table(spark, 300, 12, 5400, likelihood))
    assert _checks(registry.checked_topics(red, words), "better_than_one_topic") == [(False,)]


def _reviews(spark, n=600):
    good = F.col("id") % 3 != 0
    word = F.when(good == (F.col("id") % 20 != 0), "lovely").otherwise("awful")
    return spark.range(n).select(
        "id", F.concat(F.lit("the breakfast was "), word, F.lit(" on day "), F.col("id") % 7).alias("neg_text"),
        F.lit(None).cast("string").alias("pos_text"), F.when(good, 9.0).otherwise(5.0).alias("score"),
    )


def test_shuffled_labels_turn_the_check_red(spark):
    split = sentiment.sentiment_split(sentiment.sentiment_corpus(_reviews(spark)), ["id"])
    names = ("accuracy_is_share_of_hits", "above_larger_class", "slope_is_small")
    with sentiment.train_sentiment(split, row_keys=("id",)) as fitted:
        assert _checks(registry.checked_sentiment(fitted), *names) == [(True, True, True)]
        own = fitted.held[0]
        shuffled = split.withColumn("label", F.when(F.xxhash64("id") % 2 == 0, 1.0).otherwise(0.0))
        with sentiment.train_sentiment(shuffled) as learned_noise:
            tested = split.filter(F.col("split") == "test")
            predictions = learned_noise.model.transform(tested).select("id", "label", "prediction")
            red = replace(learned_noise, held=(own,), predictions=predictions, metrics=sentiment._metrics(own, predictions))
            assert _checks(registry.checked_sentiment(red), "above_larger_class", "slope_is_small") == [(False, False)]


def _entities(spark, n=300):
    kind = F.col("id") % 4
    return spark.range(n).select(
        F.concat(F.lit("e"), F.col("id")).alias("entity"),
        *[(kind * (i + 1) % 5 + (F.xxhash64("id", F.lit(i)) % 1000) / 5000).cast("double").alias(name) for i, name in enumerate(feature_columns())],
    )


def test_random_centres_turn_the_check_red(spark):
    found = profiling.cluster_entities(_entities(spark))
    placed = replace(found, assigned=found.assigned.withColumns({"lat": F.lit(0.0), "lng": F.lit(0.0)}))
    assert _checks(registry.checked_groups(placed), "at_nearest", "center_is_mean") == [(True, True)]

    class Elsewhere:
        def clusterCenters(self):
            return list(np.random.default_rng(2).normal(size=(4, len(feature_columns()))))

    assert (False,) in _checks(registry.checked_groups(replace(placed, model=Elsewhere())), "center_is_mean")
    assert isinstance(found.model, KMeansModel)


def test_drift_is_that_of_the_farthest_feature(spark):
    found = profiling.cluster_entities(_entities(spark), k=3, max_iter=50)
    assert all(r.drift < 1e-9 for r in diagnostics.center_drift(found.assigned, found.model).collect())


def _silhouette(points, labels):
    """Every point against every other."""
    far = ((points[:, None] - points[None]) ** 2).sum(2)
    out = []
    for i, own in enumerate(labels):
        mates = [j for j in np.flatnonzero(labels == own) if j != i]
        if not mates:
            out.append(0.0)
            continue
        a = far[i, mates].mean()
        b = min(far[i, labels == other].mean() for other in set(labels) - {own})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_silhouettes_equal_brute_force(spark):
    entities = _entities(spark, 80)
    quality = {r.k: r for r in profiling.group_quality(entities).collect()}
    assert sorted(quality) == [2, 3, 4, 5, 6]
    for k, row in quality.items():
        with profiling.cluster_entities(entities, k=k) as found:
            rows = found.assigned.select("vector", "cluster").collect()
        points, labels = np.array([r.vector.toArray() for r in rows]), np.array([r.cluster for r in rows])
        assert row.silhouette == pytest.approx(_silhouette(points, labels), abs=1e-9)
    assert [k for k, r in quality.items() if r.best] == [4] == [max(quality, key=lambda k: quality[k].silhouette)]


def test_silhouette_of_equal_entities_is_unknown(spark):
    same = spark.range(10).select(F.concat(F.lit("e"), F.col("id")).alias("entity"), *[F.lit(1.0).alias(c) for c in feature_columns()])
    assert [(r.k, r.silhouette, r.best) for r in profiling.group_quality(same, ks=(2, 3)).collect()] == [(2, None, False), (3, None, False)]


# --- lifetimes ----------------------------------------------------------------


def _persisted(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_closing_leaves_nothing_persisted(spark, monkeypatch):
    monkeypatch.setattr(durable, "shared_folder", lambda df: None)
    before = _persisted(spark)
    with profiling.cluster_entities(_entities(spark)) as found:
        assert _persisted(spark) == before + 1
        sizes = {r.cluster: r.n_entities for r in found.stats.collect()}
    assert _persisted(spark) == before
    assert {r.cluster: r.n_entities for r in found.stats.collect()} == sizes  # computed anew

    split = sentiment.sentiment_split(sentiment.sentiment_corpus(_reviews(spark)), ["id"])
    fitted = sentiment.train_sentiment(split)
    accuracy = fitted.metrics.first().accuracy
    fitted.close()
    assert _persisted(spark) == before and fitted.metrics.first().accuracy == accuracy

    topics.fit_topics(planted(spark), k=2, min_df=5)
    assert _persisted(spark) == before


def test_a_failed_fit_leaves_nothing_persisted(spark, monkeypatch):
    monkeypatch.setattr(durable, "shared_folder", lambda df: None)
    before = _persisted(spark)
    with pytest.raises(ValueError, match="clusters need"):
        profiling.cluster_entities(_entities(spark, 2))
    monkeypatch.setattr(online_lda.TopicModel, "logLikelihood", lambda self, vectors: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        topics.fit_topics(planted(spark), k=2, min_df=5)
    assert _persisted(spark) == before
