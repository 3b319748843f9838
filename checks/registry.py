"""Every operator run over the whole test tables, one entry per query."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinara.functions import rounded
from opinara.operators import cleaning, features, gap, keywords, lengths, overview, places
from opinara.operators import reliability, risk, segments, travellers
from opinara.operators.vocabulary import vocabulary
from opinara.plans import diagnostics, profiling, sentiment, topics
from opinara.plans.online_lda import TopicModel
from opinara.sources import star

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Keywords that occur in the test texts.
KEYWORDS = ("widget", "ring")
THEMES = {"construction": ("widget", "ring"), "cleanliness": ("plate", "rod"), "staff": ("gizmo",)}
#: More words than the ten shown, all of them found in the test texts.
MANY_KEYWORDS = (
    "anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget", "small", "red", "blue", "hot",
)


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# --- loading and first look -------------------------------------------------


@query
def clean_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole cleaned table; texts are shown by their length and digest."""
    kept = cleaning.clean_reviews(star.raw_reviews(spark, sf_dir))
    return kept.withColumns(
        {
            "neg_chars": F.length("neg_text"),
            "pos_chars": F.length("pos_text"),
            "neg_md5": F.md5("neg_text"),
            "pos_md5": F.md5("pos_text"),
        }
    ).drop("neg_text", "pos_text")


@query
def cleaning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.cleaning_report(star.raw_reviews(spark, sf_dir))


@query
def cleaning_report_na_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = cleaning.CleaningRules(na_text_stays=True)
    return cleaning.cleaning_report(star.raw_reviews(spark, sf_dir), rules)


@query
def dataset_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overview.dataset_overview(star.reviews(spark, sf_dir, ("entity", "prior_score")))


def _first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items to show, cut while they are narrow; dimensions and texts are joined to these alone."""
    lines = star.table(spark, sf_dir, "lineitem")
    narrow = ("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity")
    return overview.review_preview(lines, columns=None, order=narrow)


@query
def review_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.reviews(spark, sf_dir, overview.PREVIEW_COLUMNS, lines=_first_lines(spark, sf_dir))


@query
def review_preview_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.reviews(spark, sf_dir, lines=_first_lines(spark, sf_dir))


# --- segments ---------------------------------------------------------------


def _severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.segment_severity(star.reviews(spark, sf_dir, ("segment", "score")))


@query
def segment_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _severity(spark, sf_dir)


@query
def segment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.segment_summary(_severity(spark, sf_dir))


@query
def segment_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.segment_extremes(_severity(spark, sf_dir))


@query
def segment_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.segment_chart(_severity(spark, sf_dir))


# --- keywords ---------------------------------------------------------------


@query
def keyword_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.keyword_impact(star.reviews(spark, sf_dir, ("neg_text", "score")), KEYWORDS)


@query
def keyword_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.keyword_frequency(star.reviews(spark, sf_dir, ("neg_text",)), KEYWORDS)


@query
def keyword_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most frequent of a longer list, each spelling counted apart."""
    texts = star.reviews(spark, sf_dir, ("neg_text",))
    return keywords.keyword_frequency(texts, MANY_KEYWORDS, keep_case=True, top_k=10)


@query
def keyword_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled hits; equal reviews draw numbers of their own by the keys of the line items."""
    keys = ("l_orderkey", "l_linenumber")
    texts = star.reviews(spark, sf_dir, ("entity", "score", "neg_text"), keep=keys)
    return keywords.keyword_samples(texts, KEYWORDS, keys=keys)


@query
def keyword_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.keyword_verdict(keyword_impact(spark, sf_dir))


@query
def keyword_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.keyword_summary(star.reviews(spark, sf_dir, ("neg_text", "score")), KEYWORDS)


# --- travellers, lengths ----------------------------------------------------


@query
def traveller_satisfaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return travellers.traveller_satisfaction(star.reviews(spark, sf_dir, ("tags", "score")))


@query
def traveller_best_worst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return travellers.traveller_best_worst(traveller_satisfaction(spark, sf_dir))


@query
def length_asymmetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.length_asymmetry(star.reviews(spark, sf_dir, ("score", "neg_words", "pos_words")))


@query
def length_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.length_long(length_asymmetry(spark, sf_dir))


@query
def length_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.length_verdict(length_asymmetry(spark, sf_dir))


# --- entities ---------------------------------------------------------------


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.reviews(spark, sf_dir, ("entity", "prior_score", "score"))


@query
def score_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reliability.score_reliability(_scores(spark, sf_dir))


@query
def score_reliability_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reliability.score_reliability(_scores(spark, sf_dir), min_count=500, top_k=10)


@query
def hidden_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk.hidden_risk(_scores(spark, sf_dir))


@query
def hidden_risk_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk.hidden_risk(_scores(spark, sf_dir), min_prior=7.5, min_disaster_pct=15.0, top_k=3)


@query
def expectation_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gap.expectation_gap(_scores(spark, sf_dir))


@query
def gap_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gap.gap_verdict(gap.expectation_gap(_scores(spark, sf_dir), min_count=100))


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.reviews(spark, sf_dir, ("entity", "lat", "lng", "score"))


@query
def map_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places.map_points(_placed(spark, sf_dir))


@query
def map_points_thinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampling option of the map: half of the entities, all reviews of each."""
    return places.map_points(_placed(spark, sf_dir), fraction=0.5)


@query
def map_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places.map_summary(map_points(spark, sf_dir))


@query
def map_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places.map_top(map_points(spark, sf_dir))


# --- profiling --------------------------------------------------------------


@query
def entity_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    needed = ("entity", "lat", "lng", "score", "pos_text", "neg_text", "segment")
    return features.entity_features(star.reviews(spark, sf_dir, needed), THEMES)


def _by_longitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities grouped by where they lie, so that SQL can check what follows a clustering."""
    return entity_features(spark, sf_dir).withColumn("cluster", F.floor(F.col("lng") / 20).cast("int"))


@query
def region_profile_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = profiling.cluster_stats(_by_longitude(spark, sf_dir))
    named = profiling.cluster_names(stats)
    return rounded(named, 6, "mean_score", "mean_reviews", "mean_excellent", "mean_problems")


@query
def region_profile_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = _by_longitude(spark, sf_dir)
    return profiling.cluster_examples(placed, named=profiling.cluster_names(profiling.cluster_stats(placed)))


def _profiles(spark: SparkSession, sf_dir: str) -> profiling.Profiles:
    return profiling.cluster_entities(entity_features(spark, sf_dir))


@query
def cluster_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entity, whether it got a group, and how far its scaled features and its group are from what they should be."""
    return checked_groups(_profiles(spark, sf_dir))


#: A settled fit: farthest distance of a centre from its members' mean, in standard deviations; share of the slope that may be left.
SETTLED, SLOPE_LEFT = 0.1, 0.2


def checked_groups(found: profiling.Profiles) -> DataFrame:
    centers = F.array(*[F.array(*[F.lit(float(x)) for x in center]) for center in found.model.clusterCenters()])
    vector = vector_to_array("vector")

    def distance(center):
        return F.aggregate(F.zip_with(vector, center, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)

    own = distance(F.element_at(centers, F.col("cluster") + 1))
    nearest = F.array_min(F.transform(centers, distance))
    z_score = F.round(vector[0], 6)
    drift = diagnostics.center_drift(found.assigned, found.model)
    return found.assigned.join(drift, "cluster", "left").select(
        "entity", "lat", "lng", F.col("cluster").isNotNull().alias("grouped"), (z_score + 0.0).alias("z_first"),
        F.coalesce(own <= nearest + 1e-9, F.lit(True)).alias("at_nearest"),
        F.coalesce(F.col("drift") < SETTLED, F.lit(True)).alias("center_is_mean"),
    )


@query
def cluster_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silhouettes of two to six groups: in range, one of them best, and cost falling with every group more."""
    found = profiling.group_quality(entity_features(spark, sf_dir))
    by_k = Window.orderBy("k")  # five rows
    return found.select(
        "k", F.col("silhouette").between(-1, 1).alias("in_range"), (F.col("best") == (F.col("silhouette") == F.max("silhouette").over(Window.partitionBy(F.lit(1))))).alias("best_is_highest"),
        F.coalesce(F.col("cost") < F.lag("cost").over(by_k), F.lit(True)).alias("cost_falls"),
    )


@query
def cluster_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The groups put together again give the figures of all entities."""
    n = F.col("n_entities")
    whole = F.sum(n)

    def mean(name: str) -> Column:
        return F.round(F.sum(F.col(name) * n) / whole, 4).alias(name)

    return _profiles(spark, sf_dir).stats.agg(
        F.count("*").alias("n_clusters"), whole.alias("n_entities"), mean("mean_score"), mean("mean_reviews"), mean("mean_excellent"), mean("mean_problems")
    )


@query
def cluster_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names are one to each group and follow its figures."""
    named = profiling.cluster_names(_profiles(spark, sf_dir).stats)
    score, reviews, problems = F.col("mean_score"), F.col("mean_reviews"), F.col("mean_problems")
    base = (
        F.when((score >= 8.5) & (reviews > 500), "Premium Hotels").when((score >= 8) & (reviews < 200), "Hidden Gems")
        .when((score < 7) | (problems > 15), "Budget/Problems").when(reviews > 800, "Popular Mixed").otherwise("Cluster")
    )
    return named.agg(
        F.count("*").alias("n_clusters"), F.count_distinct("name").alias("n_names"), F.count_if(~F.startswith("name", base)).alias("n_wrong"), F.sum("n_entities").alias("n_entities")
    )


@query
def cluster_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best example of all groups is the best entity of all; ranks run from 1 in each group."""
    found = profiling.cluster_examples(_profiles(spark, sf_dir).assigned)
    return found.agg(
        F.count_distinct("cluster").alias("n_clusters"), F.max("mean_score").alias("best_score"), F.min("rank").alias("first_rank"), F.count_if(F.col("rank") == 1).alias("n_first")
    )


# --- sentiment: documents with a quality label -------------------------------

DOCUMENT = ("doc_id",)


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment.sentiment_corpus(star.document_reviews(spark, sf_dir, labelled=True))


def _whole_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every labelled document, split into training and test; nothing is sampled away."""
    return sentiment.sentiment_split(_labelled(spark, sf_dir), DOCUMENT, sample_fraction=1.0)


@query
def sentiment_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the whole review table with the size of the texts behind them."""
    texts = star.reviews(spark, sf_dir, ("neg_text", "pos_text", "score"))
    return (
        sentiment.sentiment_corpus(texts)
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("review")).alias("n_chars"))
    )


@query
def sentiment_corpus_without_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = star.reviews(spark, sf_dir, ("neg_text", "pos_text", "score"))
    return (
        sentiment.sentiment_corpus(texts, strip_sentinels=("No Negative", "No Positive"))
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("review")).alias("n_chars"))
    )


@query
def sentiment_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampling operator itself: 30 % of the corpus, a fifth of it held out."""
    split = sentiment.sentiment_split(_labelled(spark, sf_dir), DOCUMENT, sample_fraction=0.3)
    return split.select("doc_id", "label", "split")


@query
def sentiment_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment.sentiment_balance(_whole_split(spark, sf_dir))


@query
def sentiment_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _whole_split(spark, sf_dir).filter(F.col("split") == "train")
    return vocabulary(sentiment.sentiment_tokens(train), min_df=5, size=800)


@query
def sentiment_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the fit, whether its accuracy is the share of right predictions and above that of the larger class, and whether it has settled."""
    fitted = sentiment.train_sentiment(_whole_split(spark, sf_dir), row_keys=DOCUMENT)
    return checked_sentiment(fitted)


def checked_sentiment(fitted: sentiment.Sentiment) -> DataFrame:
    hit, positive = (F.col("label") == F.col("prediction")).cast("double"), F.avg("label")
    tested = fitted.predictions.agg(F.avg(hit).alias("hits"), F.greatest(positive, 1 - positive).alias("larger_class"))
    settled = diagnostics.slope_left(fitted.held[0], fitted.model) < SLOPE_LEFT
    return fitted.metrics.crossJoin(tested).select(  # one row each
        "n_sampled", "n_train", "n_test", "train_negative", "train_positive",
        (F.col("predicted_negative") + F.col("predicted_positive")).alias("n_predicted"),
        (F.abs(F.col("accuracy") - F.col("hits")) < 1e-12).alias("accuracy_is_share_of_hits"),
        (F.col("accuracy") > F.col("larger_class")).alias("above_larger_class"), F.lit(settled).alias("slope_is_small"),
    )


@query
def sentiment_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The held-out documents, each with a class that its probabilities favour."""
    fitted = sentiment.train_sentiment(_whole_split(spark, sf_dir), row_keys=DOCUMENT)
    chance = vector_to_array("probability")
    favoured = F.when(chance[1] > chance[0], 1.0).otherwise(0.0)
    return fitted.predictions.select("doc_id", "label", (F.col("prediction") == favoured).alias("is_favoured"))


@query
def sentiment_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = sentiment.train_sentiment(_whole_split(spark, sf_dir), row_keys=DOCUMENT)
    shown = sentiment.sentiment_examples(fitted.predictions, DOCUMENT)
    return shown.select("text", "label", F.col("prediction").isin("Pos", "Neg").alias("named"), F.col("confidence").between(0.5, 1.0).alias("likelier"))


# --- topics: documents as negative texts --------------------------------------


@query
def topic_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts and characters of the whole review table that enter topic modelling, per traveller type."""
    texts = star.reviews(spark, sf_dir, ("neg_text", "tags"))
    kind = travellers.traveller_type(F.col("tags")).alias("traveller")
    return (
        topics.topic_corpus(texts)
        .groupBy(kind)
        .agg(F.count(F.lit(1)).alias("n_texts"), F.sum(F.length("review")).alias("n_chars"))
    )


@query
def topic_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = topics.topic_corpus(star.document_reviews(spark, sf_dir))
    return vocabulary(topics.topic_tokens(corpus), min_df=15, size=1500)


def _topics(spark: SparkSession, sf_dir: str, stability: bool = False) -> topics.Topics:
    """Topics of all documents, each of which every epoch reads once."""
    return topics.fit_topics(star.document_reviews(spark, sf_dir), evaluate_stability=stability, row_keys=DOCUMENT)


@query
def topic_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The term table's shape: ranks and weights fall together, and terms are the vocabulary's."""
    terms = _topics(spark, sf_dir).terms
    words = topic_vocab(spark, sf_dir).select("term", F.lit(1).alias("known"))
    return terms.join(words, "term", "left").groupBy("topic").agg(
        F.count("*").alias("n_terms"), F.count("known").alias("n_known"), F.count_distinct("term").alias("n_distinct"), F.max("rank").alias("last_rank"), F.max("rel_weight").alias("top_rel_weight"),
        (F.max_by("rank", "weight") == 1).alias("first_is_heaviest"),
    )


@query
def topic_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the fit; perplexity is the likelihood for each token, and below that of a single topic; a topic's weights add up to 1."""
    found = _topics(spark, sf_dir)
    return checked_topics(found, [row["term_count"] for row in topic_vocab(spark, sf_dir).select("term_count").collect()])


def checked_topics(found: topics.Topics, term_counts: list[int]) -> DataFrame:
    assert found.model is not None
    agrees = F.abs(F.col("log_perplexity") * F.col("n_tokens") + F.col("log_likelihood")) < 1e-3
    error = diagnostics.topic_weight_error(found.model)
    return found.fit.select(
        "n_texts", "n_words", "n_tokens", "size_verdict", (F.col("log_likelihood") < 0).alias("likelihood_below_zero"), agrees.alias("perplexity_agrees"),
        (F.col("log_perplexity") < diagnostics.one_topic_perplexity(term_counts)).alias("better_than_one_topic"), F.lit(error < 1e-9).alias("weights_add_up"),
    )


@query
def topic_terms_of_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Term lookup and term table of a model whose word counts by topic are known: a topic for each language, the words' counts in its texts."""
    found = topic_vocab(spark, sf_dir).orderBy("idx").collect()  # vocabulary
    spelled = [row["term"] for row in found]
    words = spark.createDataFrame([(row["term"], row["idx"]) for row in found], "term string, idx int")
    tokens = topics.topic_tokens(topics.topic_corpus(star.document_reviews(spark, sf_dir))).where("segment is not null")
    counted = tokens.select("segment", F.explode("tokens").alias("term")).groupBy("segment", "term").agg(F.count("*").alias("n")).join(F.broadcast(words), "term")
    rows = counted.select("segment", "idx", "n").collect()  # languages x vocabulary, from one pass over the texts
    langs = sorted({row["segment"] for row in rows})
    counts = np.zeros((len(langs), len(spelled)))
    for row in rows:
        counts[langs.index(row["segment"]), row["idx"]] = row["n"]
    model = TopicModel(counts, alpha=1.0, eta=1.0)
    terms = topics.topic_terms(topics.topic_table(model, spelled, top_terms=10))
    return terms.select("topic", "rank", "term", F.round("weight", 9).alias("weight"), F.round("rel_weight", 9).alias("rel_weight"), "label")


@query
def topic_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One partner for each topic; the overall overlap is the matches' mean, and the verdict follows it."""
    stability = _topics(spark, sf_dir, stability=True).stability
    assert stability is not None
    overall = F.max("overall")
    verdict = F.when(overall < 0.35, "low").when(overall < 0.55, "medium").otherwise("good")
    return stability.agg(
        F.count_distinct("topic_main").alias("n_main"), F.count_distinct("topic_alt").alias("n_alt"), (F.abs(F.avg("jaccard") - overall) < 1e-9).alias("overall_is_mean"), (F.max("verdict") == verdict).alias("verdict_follows"),
    )


def _language_terms(documents: DataFrame) -> DataFrame:
    """Term sets as a topic model would give them: the ten top words of each language."""
    words = topics.topic_tokens(topics.topic_corpus(documents)).select("segment", F.explode("tokens").alias("term"))
    counted = words.groupBy("segment", "term").agg(F.count(F.lit(1)).alias("n"))
    by_count = Window.partitionBy("segment").orderBy(F.desc("n"), "term")
    top = counted.withColumn("rank", F.row_number().over(by_count)).filter(F.col("rank") <= 10)
    sets = top.groupBy("segment").agg(F.sort_array(F.collect_list("term")).alias("terms"))
    return sets.select((F.row_number().over(Window.orderBy("segment")) - 1).alias("topic"), "terms")


@query
def topic_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matching of two collections of term sets: all documents against the labelled ones."""
    found = topics.match_topics(
        _language_terms(star.document_reviews(spark, sf_dir)),
        _language_terms(star.document_reviews(spark, sf_dir, labelled=True)),
    )
    return topics.stability_report(found).select(
        "topic_main", "topic_alt", F.round("jaccard", 6).alias("jaccard"), F.round("overall", 6).alias("overall"), "verdict"
    )
