"""What are the complaints about?  Topic model over negative texts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.functions import first_match
from opinara.functions.text import longer_than
from opinara.operators.vocabulary import vocabulary
from opinara.plans.durable import in_batches, release
from opinara.plans.online_lda import TopicModel, batch_of, fit_online

# Text that stands for "nothing to complain about", tokens worth
# keeping, and words too common in this domain to tell topics apart.
NO_COMPLAINT = "No Negative"
WORD = r"\p{L}{3,}"
DOMAIN_STOP_WORDS = ("hotel", "room", "rooms", "stay", "staff", "place", "night", "nights")
# Corpus size below which topics are shaky; stability bounds.
SMALL_CORPUS = 300
LOW_STABILITY = 0.35
MEDIUM_STABILITY = 0.55

TERM_SCHEMA = "topic int, rank int, term string, weight double, rel_weight double, label string"


@dataclass(frozen=True)
class Topics:
    """``terms`` and ``fit`` describe the main model; ``stability`` compares it with a reseeded one.

    A corpus without a word that is frequent enough has no model and no terms.
    """

    model: TopicModel | None
    vocabulary: list[str]
    terms: DataFrame
    fit: DataFrame
    stability: DataFrame | None


def topic_corpus(reviews: DataFrame, min_chars: int = 30, sentinel: str = NO_COMPLAINT) -> DataFrame:
    """Reviews with a real negative text, lower-cased into ``review``."""
    text = F.col("neg_text")
    return reviews.filter((text != sentinel) & longer_than(text, min_chars)).withColumn(
        "review", F.lower(text)
    )


def topic_tokens(corpus: DataFrame, extra_stop_words: Sequence[str] = DOMAIN_STOP_WORDS) -> DataFrame:
    """Words of three letters or more, without English and domain stop words, in ``tokens``.

    SQL functions do it: the tokenizers of ``pyspark.ml`` turn each word into an object and back, twice.
    """
    stop_words = {word.lower() for word in (*StopWordsRemover.loadDefaultStopWords("english"), *extra_stop_words)}
    words = F.regexp_extract_all(F.lower("review"), F.lit(WORD), F.lit(0))
    return corpus.withColumn("tokens", F.filter(words, lambda word: ~word.isin(*sorted(stop_words))))


def topic_table(model: TopicModel, words: Sequence[str], top_terms: int) -> DataFrame:
    """``topic, terms, weights`` with the term numbers resolved.

    The vocabulary is bounded by its size parameter and travels as one literal;
    numbers outside it are dropped together with their weights.
    """
    spelled = F.transform("termIndices", lambda i: F.get(F.lit(list(words)), i))
    pairs = F.filter(
        F.arrays_zip(spelled.alias("term"), F.col("termWeights").alias("weight")),
        lambda pair: pair["term"].isNotNull(),
    )
    return (
        model.describeTopics(maxTermsPerTopic=top_terms)
        .select("topic", pairs.alias("pairs"))
        .select("topic", F.col("pairs.term").alias("terms"), F.col("pairs.weight").alias("weights"))
    )


def topic_terms(topics: DataFrame) -> DataFrame:
    """One row per topic and term: weight, weight relative to the topic's top term, topic label."""
    top = F.coalesce(F.nullif(F.array_max("weights"), F.lit(0.0)), F.lit(1.0))
    return topics.select(
        "topic",
        F.array_join(F.slice("terms", 1, 3), ", ").alias("label"),
        top.alias("top_weight"),
        F.posexplode(F.arrays_zip(F.col("terms").alias("term"), F.col("weights").alias("weight"))).alias(
            "pos", "pair"
        ),
    ).select(
        "topic",
        (F.col("pos") + 1).alias("rank"),
        "pair.term",
        "pair.weight",
        (F.col("pair.weight") / F.col("top_weight")).alias("rel_weight"),
        "label",
    )


def jaccard(left: Column, right: Column) -> Column:
    """Overlap of two term sets; two empty sets are equal, one empty set shares nothing."""
    union = F.size(F.array_union(left, right))
    return F.when(union == 0, 1.0).otherwise(
        F.size(F.array_intersect(left, right)) / F.greatest(union, F.lit(1))
    )


def match_topics(main: DataFrame, alternative: DataFrame) -> DataFrame:
    """Pair the topics of two fits one to one, each main topic in turn taking its best free partner.

    Both inputs are ``topic, terms`` with one row per topic, so all of it fits in
    one row: candidates sorted by main topic, falling similarity and partner
    number are folded, keeping a pair when both its ends are still free.
    ``overall`` is the mean overlap of the matches.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("side"), F.struct("topic", "terms").alias("entry"))

    def entries(name: str) -> Column:
        return F.collect_list(F.when(F.col("side") == name, F.col("entry"))).alias(name)

    def candidate(m: Column, a: Column) -> Column:
        score = jaccard(m["terms"], a["terms"])
        return F.struct(
            m["topic"].alias("topic_main"),
            (-score).alias("order"),
            a["topic"].alias("topic_alt"),
            score.alias("jaccard"),
            m["terms"].alias("main_terms"),
            a["terms"].alias("alt_terms"),
        )

    def keep(matched: Column, pair: Column) -> Column:
        taken = F.exists(
            matched,
            lambda m: (m["topic_main"] == pair["topic_main"]) | (m["topic_alt"] == pair["topic_alt"]),
        )
        return F.when(taken, matched).otherwise(F.concat(matched, F.array(pair)))

    both = side(main, "main").unionByName(side(alternative, "alt")).agg(entries("main"), entries("alt"))
    candidates = F.array_sort(
        F.flatten(F.transform("main", lambda m: F.transform("alt", lambda a: candidate(m, a))))
    )
    listed = both.select(candidates.alias("candidates"))
    matched = F.aggregate("candidates", F.slice("candidates", 1, 0), keep)
    total = F.aggregate("matched", F.lit(0.0), lambda sum_, m: sum_ + m["jaccard"])
    return (
        listed.select(matched.alias("matched"))
        .select(F.try_divide(total, F.size("matched")).alias("overall"), F.inline("matched"))
        .drop("order")
    )


def stability_report(matches: DataFrame) -> DataFrame:
    """The matches with what their mean overlap says about the topics."""
    overall = F.col("overall")
    bounds = [(overall < LOW_STABILITY, "low"), (overall < MEDIUM_STABILITY, "medium")]
    return matches.withColumn("verdict", first_match(bounds, "good"))


def fit_topics(
    reviews: DataFrame,
    k: int = 3,
    top_terms: int = 10,
    evaluate_stability: bool = True,
    seed: int = 42,
    alternative_seed: int = 99,
    batches: int = 20,
    epochs: int = 1,
    vocab_size: int = 1500,
    min_df: int = 15,
    min_chars: int = 30,
    sentinel: str = NO_COMPLAINT,
    extra_stop_words: Sequence[str] = DOMAIN_STOP_WORDS,
    row_keys: Sequence[str] = (),
) -> Topics:
    """Online LDA over negative texts, with an optional second fit to test its stability.

    A text is in one of ``batches`` mini-batches, by the hash of its words and of the columns ``row_keys``, which should name a row, so that
    copies of one text spread.  An epoch takes the batches in turn and meets every text once; each step reads its own batch only.

    The texts are tokenised twice, for the vocabulary and for the stored count vectors.  Both fits learn in the same passes over these.
    """
    spark = reviews.sparkSession
    corpus = topic_corpus(reviews, min_chars, sentinel)
    tokens = topic_tokens(corpus, extra_stop_words)
    rows = vocabulary(tokens, min_df, vocab_size).orderBy("idx").collect()
    if not rows:
        return Topics(None, [], spark.createDataFrame([], TERM_SCHEMA), _fit_table(spark, corpus.count()), None)
    words = [row.term for row in rows]
    n_tokens = sum(row.term_count for row in rows)

    counter = CountVectorizerModel.from_vocabulary(words, inputCol="tokens", outputCol="features")
    key = F.xxhash64("review", *row_keys)
    counts = counter.transform(tokens).select(batch_of(key, batches).alias("batch"), key.alias("key"), "features")
    vectors, n_texts = in_batches(counts, "batch", batches, F.col("key"))
    try:
        seeds = (seed, alternative_seed) if evaluate_stability else (seed,)
        model, *others = fit_online(vectors, len(words), k, seeds, epochs=epochs)
        likelihood = model.logLikelihood(vectors)
    finally:
        release(vectors)
    described = topic_table(model, words, top_terms)
    stability = None
    if others:
        stability = stability_report(match_topics(described, topic_table(others[0], words, top_terms)))
    quality = _fit_table(spark, n_texts, len(words), n_tokens, likelihood)
    return Topics(model, words, topic_terms(described), quality, stability)


def _fit_table(
    spark: SparkSession, n_texts: int, n_words: int = 0, n_tokens: int = 0, likelihood: float | None = None
) -> DataFrame:
    """One row of quality figures; perplexity per token follows from the likelihood."""
    perplexity = None if likelihood is None else -likelihood / n_tokens
    row = [(n_texts, n_words, n_tokens, likelihood, perplexity)]
    schema = "n_texts bigint, n_words bigint, n_tokens bigint, log_likelihood double, log_perplexity double"
    size = first_match([(F.col("n_texts") < SMALL_CORPUS, "small corpus")], "large enough")
    return spark.createDataFrame(row, schema).withColumn("size_verdict", size)
