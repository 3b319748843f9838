"""Does the text tell whether the score was good?"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizerModel, StopWordsRemover, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import first_match, hash_order, in_fraction
from opinara.functions.text import longer_than
from opinara.operators.vocabulary import vocabulary
from opinara.plans.durable import Lasting, durable

# Fixed value: the score from which a review counts as positive.
POSITIVE_FROM = 7.5


@dataclass(frozen=True)
class Sentiment(Lasting):
    """A fitted pipeline, its hold-out predictions and one row of metrics; holds the training vectors until it is closed."""

    model: PipelineModel
    predictions: DataFrame
    metrics: DataFrame
    held: tuple[DataFrame, ...] = ()


def sentiment_corpus(
    reviews: DataFrame,
    min_chars: int = 20,
    positive_from: float = POSITIVE_FROM,
    strip_sentinels: Sequence[str] = (),
) -> DataFrame:
    """Adds ``review`` (negative then positive text) and ``label``; short texts go.

    A missing score counts as not positive.  Texts listed in ``strip_sentinels``
    ("No Negative") are left out of the review; by default they stay in.
    """

    def spoken(name: str) -> Column:
        text = F.col(name)
        return F.when(~text.isin(*strip_sentinels), text) if strip_sentinels else text

    return reviews.withColumns(
        {
            "review": F.concat_ws(" ", spoken("neg_text"), spoken("pos_text")),
            "label": F.when(F.col("score") >= positive_from, 1.0).otherwise(0.0),
        }
    ).filter(longer_than(F.col("review"), min_chars))


def sentiment_split(
    corpus: DataFrame,
    keys: Sequence[str],
    sample_fraction: float = 1.0,
    test_fraction: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """A keyed sample of the corpus with ``split`` = train or test.

    Sample and split hash the key with different seeds, so they are independent.  A
    ``sample_fraction`` below 1 leaves the other rows out of both parts.
    """
    drawn = corpus
    if sample_fraction < 1.0:
        drawn = corpus.filter(in_fraction(*keys, fraction=sample_fraction, seed=f"sample-{seed}"))
    held_out = in_fraction(*keys, fraction=test_fraction, seed=f"split-{seed}")
    return drawn.withColumn("split", F.when(held_out, "test").otherwise("train"))


def sentiment_tokens(corpus: DataFrame, text: str = "review") -> DataFrame:
    """Lower-cased words without English stop words, in ``tokens``."""
    words = Tokenizer(inputCol=text, outputCol="words").transform(corpus)
    return StopWordsRemover(inputCol="words", outputCol="tokens").transform(words).drop("words")


def sentiment_balance(split: DataFrame) -> DataFrame:
    """Size of the training set and positives per negative."""
    train = F.col("split") == "train"
    return split.agg(
        F.count_if(train).alias("n_train"),
        F.count_if(train & (F.col("label") == 0.0)).alias("n_negative"),
        F.count_if(train & (F.col("label") == 1.0)).alias("n_positive"),
    ).withColumn("balance", F.col("n_positive") / F.greatest("n_negative", F.lit(1)))


def train_sentiment(
    split: DataFrame,
    vocab_size: int = 800,
    min_df: int = 5,
    max_iter: int = 10,
    reg_param: float = 0.01,
    row_keys: Sequence[str] = (),
) -> Sentiment:
    """Word counts, inverse document frequency and logistic regression.

    The training texts are read twice, once for the vocabulary and once for the
    count vectors; all iterations then run on the stored vectors, dealt by text and by the columns
    ``row_keys``, which should name a row, so that copies of one text spread.
    """
    train = split.filter(F.col("split") == "train")
    words = vocabulary(sentiment_tokens(train), min_df, vocab_size).orderBy("idx").collect()
    if not words:
        raise ValueError(f"no word occurs in {min_df} training texts")

    tokenizer = Tokenizer(inputCol="review", outputCol="words")
    remover = StopWordsRemover(inputCol="words", outputCol="tokens")
    counter = CountVectorizerModel.from_vocabulary(
        [row.term for row in words], inputCol="tokens", outputCol="counts"
    )
    counts = PipelineModel([tokenizer, remover, counter]).transform(train)
    row = F.xxhash64("review", *row_keys)
    stored = durable(counts.select(row.alias("row"), "label", "counts"), "row", "label")

    idf = IDF(inputCol="counts", outputCol="features").fit(stored)
    classifier = LogisticRegression(maxIter=max_iter, regParam=reg_param).fit(idf.transform(stored))
    model = PipelineModel([tokenizer, remover, counter, idf, classifier])

    scored = model.transform(split.filter(F.col("split") == "test"))
    predictions = scored.drop("words", "tokens", "counts", "features", "rawPrediction")
    return Sentiment(model, predictions, _metrics(stored, predictions), (stored,))


def _metrics(train: DataFrame, predictions: DataFrame) -> DataFrame:
    """All counts and the accuracy from one aggregate over both parts."""
    both = train.select("label", F.lit(None).cast("double").alias("prediction")).unionByName(
        predictions.select("label", "prediction")
    )
    tested, label, guess = F.col("prediction").isNotNull(), F.col("label"), F.col("prediction")
    return both.agg(
        F.avg(F.when(tested, (label == guess).cast("double"))).alias("accuracy"),
        F.count(F.lit(1)).alias("n_sampled"),
        F.count_if(~tested).alias("n_train"),
        F.count_if(tested).alias("n_test"),
        F.count_if(~tested & (label == 0.0)).alias("train_negative"),
        F.count_if(~tested & (label == 1.0)).alias("train_positive"),
        F.count_if(guess == 0.0).alias("predicted_negative"),
        F.count_if(guess == 1.0).alias("predicted_positive"),
    )


def sentiment_examples(
    predictions: DataFrame, keys: Sequence[str], n: int = 10, max_chars: int | None = None, seed: int = 42
) -> DataFrame:
    """``n`` predictions for reading: words for the classes, the likelier class's probability.

    ``max_chars`` cuts longer texts short for display and marks the cut with dots.
    """
    text = F.col("review")
    if max_chars is not None:
        cut = F.concat(F.substring("review", 1, max_chars), F.lit("..."))
        text = F.when(F.length("review") > max_chars, cut).otherwise(text)

    def word(name: str) -> Column:
        return first_match([(F.col(name) == 1.0, "Pos")], "Neg")

    return (
        predictions.orderBy(hash_order(*keys, seed=f"examples-{seed}"), *keys)
        .limit(n)
        .select(
            text.alias("text"),
            word("label").alias("label"),
            word("prediction").alias("prediction"),
            F.array_max(vector_to_array("probability")).alias("confidence"),
        )
    )
