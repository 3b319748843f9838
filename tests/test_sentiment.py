from __future__ import annotations

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from checks.sql import ENGLISH_STOP_WORDS
from opinara.operators.vocabulary import vocabulary
from opinara.plans import sentiment

SCHEMA = "neg_text string, pos_text string, score double"


def test_corpus_labels_and_length(frame):
    df = frame(
        [
            ("a" * 10, "b" * 9, 9.0),  # 20 characters with the blank, too short
            ("a" * 10, "b" * 10, 7.5),
            ("a" * 30, None, 7.4999),
            (None, "b" * 30, None),
            ("No Negative", "b" * 10, 8.0),
        ],
        SCHEMA,
    )
    assert [r.label for r in sentiment.sentiment_corpus(df).collect()] == [1.0, 0.0, 0.0, 1.0]
    stripped = sentiment.sentiment_corpus(df, strip_sentinels=("No Negative",)).collect()
    assert [len(r.review) for r in stripped] == [21, 30, 30]


def test_split_is_disjoint_complete_and_independent_of_the_sample(spark):
    df = spark.range(20000).withColumn("label", F.lit(1.0))
    whole = sentiment.sentiment_split(df, ["id"], sample_fraction=1.0)
    counts = {r.split: r["count"] for r in whole.groupBy("split").count().collect()}
    assert sum(counts.values()) == 20000 and 0.19 < counts["test"] / 20000 < 0.21
    drawn = sentiment.sentiment_split(df, ["id"], sample_fraction=0.3)
    share = drawn.filter("split = 'test'").count() / drawn.count()
    assert 0.18 < share < 0.22 and 0.28 < drawn.count() / 20000 < 0.32
    assert drawn.exceptAll(whole).count() == 0


def test_tokens_keep_inner_blanks_and_drop_stop_words(frame):
    df = frame([("  A  cold\n Room ",), ("the",)], "review string")
    assert [r.tokens for r in sentiment.sentiment_tokens(df).collect()] == [
        ["", "", "", "cold", "", "room"], [],
    ]


def test_stop_words_of_the_sql_check_are_sparks(spark):
    assert ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_vocabulary_counts_and_deterministic_cut(frame):
    df = frame([(["b", "a", "a"],), (["a", "c"],), (["b", "c"],), ([],), (None,)], "tokens array<string>")
    found = [tuple(r) for r in vocabulary(df, min_df=1, size=10).orderBy("idx").collect()]
    assert found == [("a", 3, 2, 0), ("b", 2, 2, 1), ("c", 2, 2, 2)]
    assert [r.term for r in vocabulary(df, 1, 2).orderBy("idx").collect()] == ["a", "b"]
    assert vocabulary(df, min_df=3, size=10).count() == 0


def planted(spark, n=400):
    """Good reviews say lovely, bad ones awful, nearly always."""
    good = F.col("id") % 3 != 0
    clear = F.col("id") % 20 != 0
    word = F.when(good == clear, "lovely").otherwise("awful")
    return spark.range(n).select(
        "id",
        F.concat(F.lit("the breakfast was "), word, F.lit(" on day "), F.col("id") % 7).alias("neg_text"),
        F.lit(None).cast("string").alias("pos_text"),
        F.when(good, 9.0).otherwise(5.0).alias("score"),
    )


def test_model_learns_a_planted_signal_and_metrics_add_up(spark):
    corpus = sentiment.sentiment_corpus(planted(spark))
    split = sentiment.sentiment_split(corpus, ["id"], sample_fraction=1.0)
    fitted = sentiment.train_sentiment(split)
    row = fitted.metrics.first()
    predictions = fitted.predictions.collect()
    majority = max(sum(r.label for r in predictions), sum(1 - r.label for r in predictions)) / len(predictions)
    assert row.accuracy == sum(r.label == r.prediction for r in predictions) / len(predictions)
    assert row.accuracy > majority
    assert row.n_sampled == 400 == row.n_train + row.n_test
    assert row.n_train == row.train_negative + row.train_positive
    assert row.n_test == row.predicted_negative + row.predicted_positive
    balance = sentiment.sentiment_balance(split).first()
    assert (balance.n_train, balance.n_positive) == (row.n_train, row.train_positive)
    assert balance.balance == row.train_positive / row.train_negative

    shown = sentiment.sentiment_examples(fitted.predictions, ["id"]).collect()
    assert len(shown) == 10
    assert all(0.5 <= r.confidence <= 1.0 for r in shown)
    assert {r.text for r in shown} <= {r.review for r in corpus.collect()}
    short = sentiment.sentiment_examples(fitted.predictions, ["id"], max_chars=5).collect()
    assert all(r.text.endswith("...") and len(r.text) == 8 for r in short)
    assert {r.label for r in shown} | {r.prediction for r in shown} <= {"Pos", "Neg"}
    scored = fitted.model.transform(corpus.limit(1)).first()
    assert scored.prediction in (0.0, 1.0)


def test_balance_without_negatives(frame):
    split = frame([("train", 1.0), ("train", 1.0), ("test", 0.0)], "split string, label double")
    assert sentiment.sentiment_balance(split).first().balance == 2.0


def test_empty_vocabulary_is_reported(spark):
    split = sentiment.sentiment_split(sentiment.sentiment_corpus(planted(spark, 3)), ["id"], 1.0)
    with pytest.raises(ValueError, match="no word"):
        sentiment.train_sentiment(split, min_df=50)
