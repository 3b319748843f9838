from __future__ import annotations

import random

import pytest
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import functions as F

from opinara.plans import topics

TOPIC_SCHEMA = "topic int, terms array<string>"


def test_corpus_needs_a_long_real_complaint(frame):
    df = frame([("x" * 30,), ("X" * 31,), ("No Negative",), (None,), ("",)], "neg_text string")
    assert [r.review for r in topics.topic_corpus(df).collect()] == ["x" * 31]


def test_tokens_are_letter_runs(frame):
    df = frame([("the hotel's wi-fi: 3rd floor, été naïve aa bbb4ccc rooms",), ("",)], "review string")
    assert [r.tokens for r in topics.topic_tokens(df).collect()] == [
        ["floor", "été", "naïve", "bbb", "ccc"], [],
    ]


def overlap(a, b):
    if not a and not b:
        return 1.0
    return len(set(a) & set(b)) / len(set(a) | set(b))


def expected_matches(main, alternative):
    """Brute force: all pairs from best to worst within each main topic in turn."""
    free = set(range(len(alternative)))
    out = []
    for i, terms in enumerate(main):
        if free:
            j = max(sorted(free), key=lambda j: overlap(terms, alternative[j]))
            free.remove(j)
            out.append((i, j, overlap(terms, alternative[j])))
    return out


@pytest.mark.parametrize("k, seed", [(1, 1), (2, 2), (4, 3), (6, 4), (10, 5)])
def test_matching_equals_brute_force(frame, k, seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(8)]
    make = lambda: [draw.sample(words, draw.choice([0, 1, 2, 5])) for _ in range(k)]
    main, alternative = make(), make()
    found = topics.match_topics(
        frame(list(enumerate(main)), TOPIC_SCHEMA).repartition(3), frame(list(enumerate(alternative)), TOPIC_SCHEMA)
    )
    pairs = sorted((r.topic_main, r.topic_alt, r.jaccard) for r in found.collect())
    assert pairs == expected_matches(main, alternative)
    report = topics.stability_report(found).collect()
    assert all(r.overall == pytest.approx(sum(p[2] for p in pairs) / k) for r in report)


def test_nothing_to_match(frame):
    assert topics.match_topics(frame([], TOPIC_SCHEMA), frame([], TOPIC_SCHEMA)).count() == 0
    assert topics.match_topics(frame([], TOPIC_SCHEMA), frame([], TOPIC_SCHEMA)).collect() == []


@pytest.mark.parametrize(
    "shared, verdict", [(3, "low"), (4, "medium"), (5, "medium"), (6, "good"), (10, "good")]
)
def test_stability_verdict(frame, shared, verdict):
    matches = frame([(0, 0, shared / 10)], "topic_main int, topic_alt int, overall double")
    assert topics.stability_report(matches).first().verdict == verdict


def planted(spark, n=300):
    """Two kinds of complaints with disjoint words."""
    noise = F.lit("noise street traffic window loud sleep ")
    bath = F.lit("shower water cold bathroom towel dirty ")
    return spark.range(n).select(
        "id", F.repeat(F.when(F.col("id") % 2 == 0, noise).otherwise(bath), 3).alias("neg_text")
    )


def counted(reviews, words):
    """Count vectors of the topic texts of ``reviews``."""
    counter = CountVectorizerModel.from_vocabulary(words, inputCol="tokens", outputCol="features")
    return counter.transform(topics.topic_tokens(topics.topic_corpus(reviews)))


def test_fit_invariants(spark):
    fitted = topics.fit_topics(planted(spark), k=2, top_terms=4, min_df=5)
    terms = fitted.terms.orderBy("topic", "rank").collect()
    assert len(terms) == 8 and {r.term for r in terms} <= set(fitted.vocabulary)
    for topic in (0, 1):
        weights = [r.weight for r in terms if r.topic == topic]
        assert weights == sorted(weights, reverse=True) and min(weights) > 0
        relative = [r.rel_weight for r in terms if r.topic == topic]
        assert relative[0] == 1.0 and all(0 < w <= 1 for w in relative)
        first = [r.term for r in terms if r.topic == topic][:3]
        assert {r.label for r in terms if r.topic == topic} == {", ".join(first)}
    fit = fitted.fit.first()
    assert (fit.n_texts, fit.n_words, fit.n_tokens) == (300, 12, 300 * 18)
    assert fit.log_perplexity == pytest.approx(-fit.log_likelihood / fit.n_tokens)
    assert fit.size_verdict == "large enough"
    stability = fitted.stability.collect()
    assert sorted(r.topic_main for r in stability) == [0, 1]
    assert len({r.topic_alt for r in stability}) == 2
    assert all(0.0 <= r.jaccard <= 1.0 for r in stability)
    again = topics.fit_topics(planted(spark), k=2, top_terms=4, min_df=5, evaluate_stability=False)
    assert again.terms.orderBy("topic", "rank").collect() == terms and again.stability is None


def test_perplexity_is_that_of_the_stored_texts(spark):
    fitted = topics.fit_topics(planted(spark), k=2, min_df=5, evaluate_stability=False)
    vectors = counted(planted(spark), fitted.vocabulary)
    assert fitted.fit.first().log_perplexity == pytest.approx(fitted.model.logPerplexity(vectors))


def test_small_corpus_and_empty_vocabulary(spark):
    small = topics.fit_topics(planted(spark, 40), k=2, min_df=5, evaluate_stability=False)
    assert small.fit.first().size_verdict == "small corpus"
    empty = topics.fit_topics(planted(spark, 10), min_df=50)
    assert empty.model is None and empty.vocabulary == [] and empty.terms.count() == 0
    assert empty.terms.columns == small.terms.columns
    row = empty.fit.first()
    assert (row.n_texts, row.n_words, row.log_perplexity) == (10, 0, None)


@pytest.mark.parametrize("parts, coalesce", [(2, "true"), (5, "false"), (7, "false")])
def test_topics_do_not_depend_on_the_layout(spark, parts, coalesce):
    def terms(df):
        fitted = topics.fit_topics(df, k=2, top_terms=4, min_df=5, evaluate_stability=False)
        return [(r.topic, r.rank, r.term) for r in fitted.terms.orderBy("topic", "rank").collect()]

    expected = terms(planted(spark))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        assert terms(planted(spark).repartition(parts)) == expected
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_languages_read_the_texts_twice_and_words_stay_in_sql(spark, frame, monkeypatch):
    """One pass each for the vocabulary and for the counts by language; no tokenizer that makes objects of words."""
    from checks import registry

    seen = spark.sparkContext.accumulator(0)
    rows = frame([(i, "s", "en" if i % 2 else "de", "grand wasser garden castle the Hotel " * 3) for i in range(40)], "doc_id long, entity string, segment string, neg_text string")
    assert "UDF" not in topics.topic_tokens(topics.topic_corpus(rows))._jdf.queryExecution().optimizedPlan().toString()

    def counting(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    monkeypatch.setattr(registry.star, "document_reviews", lambda *_: rows.mapInPandas(counting, rows.schema))
    terms = registry.topic_terms_of_languages(spark, "").collect()
    assert seen.value == 2 * 40
    assert {r.term for r in terms} == {"grand", "wasser", "garden", "castle"}
