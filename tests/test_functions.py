from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from opinara.functions import PRESTIGE_BINS, SCORE_BINS, Bins, first_match, hash_order, in_fraction
from opinara.functions.text import any_part, first_word, longer_than, mentions, whole_word


def test_score_bins_are_half_open_and_nulls_go_last(frame):
    scores = [0.0, 4.999, 5.0, 7.4999, 7.5, 8.9999, 9.0, 10.0, None]
    df = frame([(s,) for s in scores], "score double").withColumn("b", SCORE_BINS.id(F.col("score")))
    assert [row.b for row in df.collect()] == [0, 0, 1, 1, 2, 2, 3, 3, 3]


def test_prestige_bins_and_labels(frame):
    df = frame([(s,) for s in (7.4999, 7.5, 8.5, 9.1999, 9.2, None)], "prior double")
    bin_id = PRESTIGE_BINS.id(F.col("prior"))
    rows = df.select(bin_id.alias("b"), PRESTIGE_BINS.label(bin_id).alias("label")).collect()
    assert [row.b for row in rows] == [0, 1, 2, 2, 3, 3]
    assert [row.label.split()[0] for row in rows] == [
        "economy", "standard", "premium", "premium", "luxury", "luxury",
    ]


@pytest.mark.parametrize("edges, labels", [((1.0,), ("a",)), ((2.0, 1.0), ("a", "b", "c"))])
def test_bins_reject_bad_definitions(edges, labels):
    with pytest.raises(ValueError):
        Bins(edges, labels)


def test_first_match_takes_the_first_true_rule_and_skips_null_conditions(frame):
    df = frame([(1,), (5,), (None,)], "x int")
    label = first_match([(F.col("x") < 3, "small"), (F.col("x") < 9, "medium")], "none")
    assert [row[0] for row in df.select(label).collect()] == ["small", "medium", "none"]


def test_hash_order_is_the_md5_prefix(frame):
    df = frame([("a", 7.5)], "k string, s double")
    expected = int(hashlib.md5(b"a|7.5|42").hexdigest()[:8], 16)
    assert df.select(hash_order("k", "s", seed=42)).first()[0] == expected


def test_in_fraction_is_independent_of_partitioning_and_nested(spark):
    df = spark.range(20000).withColumn("id", F.col("id").cast("string"))
    third = {r.id for r in df.filter(in_fraction("id", fraction=0.3, seed=1)).collect()}
    again = {r.id for r in df.repartition(7).filter(in_fraction("id", fraction=0.3, seed=1)).collect()}
    more = {r.id for r in df.filter(in_fraction("id", fraction=0.5, seed=1)).collect()}
    assert third == again and third < more
    assert 0.28 < len(third) / 20000 < 0.32
    assert df.filter(in_fraction("id", fraction=1.0, seed=1)).count() == 20000
    assert df.filter(in_fraction("id", fraction=0.0, seed=1)).count() == 0


@pytest.mark.parametrize("make", [any_part, whole_word])
def test_mentions_equals_the_pattern_alone(frame, make):
    words = ("works", "building work", "noise")
    texts = [
        "WORKS", "networks", "Building  work", "building Work!", "noises", "a noise.", "wor\u212as", "no\u0130se",
        "works\u00e9", "", "quiet", None,
    ]
    df = frame([(t,) for t in texts], "t string")
    both = df.select(
        mentions(F.col("t"), words, make(words)).alias("fast"), F.col("t").rlike(make(words)).alias("plain")
    ).collect()
    assert [r.fast for r in both] == [r.plain for r in both]


@pytest.mark.parametrize("words", [(), ("Works",), ("a|b",), ("",)])
def test_search_words_are_checked(words):
    with pytest.raises(ValueError):
        any_part(words)


@pytest.mark.parametrize("words", [("works", "works late"), ("ring", "red", "widget"), ("a", "ab", "b c")])
def test_first_word_is_what_the_plain_pattern_finds(frame, words):
    draw = random.Random(len(words))
    pieces = [*words, *(w.upper() for w in words), *(w.title() for w in words), " ", "-", "é", "x", "_", "1", "\n", "ſ", "K"]
    texts = [None, "", *("".join(draw.choices(pieces, k=draw.randrange(12))) for _ in range(400))]
    df = frame([(t,) for t in texts], "t string")
    plain = rf"(?i)\b({'|'.join(words)})\b"
    found = df.select(first_word(F.col("t"), words).alias("new"), F.nullif(F.regexp_extract("t", plain, 1), F.lit("")).alias("old"), F.col("t").rlike(whole_word(words)).alias("hit"), F.col("t").rlike(plain).alias("old_hit")).collect()
    assert [(r.new, r.hit) for r in found] == [(r.old, r.old_hit) for r in found]
    assert any(r.new for r in found) and not all(r.hit for r in found)


def test_longer_than_counts_short_texts_only(frame):
    texts = [None, "", "é" * 20, "é" * 21, "😀" * 20, "😀" * 21, "x" * 20, "x" * 21, "x" * 80, "x" * 81, "y" * 9000]
    df = frame([(t,) for t in texts], "t string").select("t", longer_than(F.col("t"), 20).alias("fast"), (F.length("t") > 20).alias("plain"), F.octet_length("t").alias("bytes"))
    assert all(r.fast == r.plain for r in df.collect())
    assert "octet_length" in df._jdf.queryExecution().optimizedPlan().toString()
