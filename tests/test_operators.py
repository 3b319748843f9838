"""Boundary rows, null policies and properties of the relational operators."""

from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from opinara.operators import features, gap, keywords, lengths, overview, places
from opinara.operators import reliability, risk, segments, travellers


def rows(df):
    return [row.asDict() for row in df.collect()]


def scored(frame, groups, column="entity"):
    """``groups``: name -> list of scores."""
    data = [(name, score) for name, scores in groups.items() for score in scores]
    return frame(data, f"{column} string, score double")


# --- segments -----------------------------------------------------------------


def test_segment_severity_trims_and_needs_more_than_the_minimum(frame):
    df = scored(frame, {" A ": [5.0] * 100, "A": [7.0], " B ": [8.0] * 100}, "segment")
    found = rows(segments.segment_severity(df))
    assert [r["segment"] for r in found] == ["A"]
    assert found[0]["n"] == 101 and found[0]["mean_score"] == round((500 + 7) / 101, 3)


def test_segment_severity_counts_rows_without_score(frame):
    df = scored(frame, {"A": [4.0, None, 6.0], "B": [None, None]}, "segment")
    found = {r["segment"]: r for r in rows(segments.segment_severity(df, min_count=1))}
    assert found["A"]["n"] == 3 and found["A"]["mean_score"] == 5.0
    assert found["A"]["std_score"] == round(statistics.stdev([4.0, 6.0]), 3)
    assert found["B"]["mean_score"] is None and found["B"]["std_score"] is None


def test_segment_extremes_overlap_when_few_and_break_ties_by_name(frame):
    df = scored(frame, {"C": [5.0, 5.0], "A": [5.0, 5.0], "B": [9.0, 9.0]}, "segment")
    severity = segments.segment_severity(df, min_count=1)
    found = sorted((r["side"], r["rank"], r["segment"]) for r in rows(segments.segment_extremes(severity, 2)))
    assert found == [("critical", 1, "A"), ("critical", 2, "C"), ("generous", 1, "B"), ("generous", 2, "A")]
    chart = rows(segments.segment_chart(severity, 2))
    assert [r["label"] for r in chart] == ["A (2)", "A (2)", "C (2)", "B (2)"]


def test_segment_summary_of_nothing(frame):
    severity = segments.segment_severity(frame([], "segment string, score double"))
    assert rows(segments.segment_summary(severity)) == [
        {"n_segments": 0, "mean_std": None, "mean_range": None}
    ]


# --- keywords -------------------------------------------------------------------

TEXTS = [
    ("Works all night", 4.0),
    ("networks were slow", 8.0),
    ("renovation and works", 5.0),
    ("construction", 6.0),
    ("nothing", 9.0),
    ("", 7.0),
    (None, 3.0),
]


def texts(frame):
    return frame([("h", *row) for row in TEXTS], "entity string, neg_text string, score double")


def test_keyword_impact_has_a_third_group_for_missing_text(frame):
    found = {r["has_keyword"]: r for r in rows(keywords.keyword_impact(texts(frame)))}
    assert {flag: r["n"] for flag, r in found.items()} == {True: 3, False: 3, None: 1}
    std = statistics.stdev([4.0, 5.0, 6.0])
    assert found[True]["ci95"] == round(1.96 * std / math.sqrt(3), 3)
    assert found[None]["std_score"] is None and found[None]["ci95"] is None


def test_keyword_frequency_takes_the_first_hit_and_folds_case(frame):
    more = texts(frame).unionByName(frame([("h", "the works", 5.0)], "entity string, neg_text string, score double"))
    folded = {r["keyword"]: r["n"] for r in rows(keywords.keyword_frequency(more))}
    assert folded == {"works": 2, "renovation": 1, "construction": 1}
    kept = {r["keyword"]: r["n"] for r in rows(keywords.keyword_frequency(more, keep_case=True))}
    assert kept == {"Works": 1, "works": 1, "renovation": 1, "construction": 1}
    assert [r["keyword"] for r in rows(keywords.keyword_frequency(more, top_k=1))] == ["works"]


def test_keyword_samples_repeat_whatever_the_partitioning(frame):
    first = rows(keywords.keyword_samples(texts(frame), n=2))
    again = rows(keywords.keyword_samples(texts(frame).repartition(5), n=2))
    assert first == again and len(first) == 2


def test_keyword_summary_agrees_with_the_single_tables(frame):
    df = texts(frame)
    found = rows(keywords.keyword_summary(df))
    impact = {r["has_keyword"]: r for r in rows(keywords.keyword_impact(df))}
    assert {r["has_keyword"] for r in found} == set(impact)
    for r in found:
        assert all(r[c] == impact[r["has_keyword"]][c] for c in ("n", "mean_score", "std_score", "ci95"))
    counts = {r["keyword"]: r["n_keyword"] for r in found if r["keyword"] is not None}
    assert counts == {r["keyword"]: r["n"] for r in rows(keywords.keyword_frequency(df))}
    verdict = rows(keywords.keyword_verdict(keywords.keyword_impact(df)))
    assert {(r["diff"], r["threshold"], r["verdict"]) for r in found} == {(v["diff"], v["threshold"], v["verdict"]) for v in verdict}


def test_keyword_report_bundles_the_tables(frame):
    report = keywords.keyword_report(texts(frame), sample_size=1)
    assert rows(report.impact) == rows(keywords.keyword_impact(texts(frame)))
    assert len(rows(report.frequency)) == 2 + 1 and len(rows(report.samples)) == 1
    assert rows(report.verdict)[0]["verdict"] == "strong"


@pytest.mark.parametrize(
    "hit, other, ci, verdict",
    [
        (5.0, 7.0, 0.5, "strong"),
        (6.5, 7.0, 0.5, "mild"),
        (6.0, 7.0, 0.5, "mild"),
        (7.0, 7.0, 0.5, "none"),
        (6.5, 7.0, None, "strong"),
        (6.75, 7.0, None, "mild"),
    ],
)
def test_keyword_verdict(frame, hit, other, ci, verdict):
    impact = frame(
        [(True, hit, ci), (False, other, ci), (None, 1.0, ci)],
        "has_keyword boolean, mean_score double, ci95 double",
    )
    assert rows(keywords.keyword_verdict(impact))[0]["verdict"] == verdict


def test_keyword_verdict_needs_both_sides(frame):
    one = frame([(False, 7.0, 0.1)], "has_keyword boolean, mean_score double, ci95 double")
    assert rows(keywords.keyword_verdict(one)) == []


# --- travellers -------------------------------------------------------------------


@pytest.mark.parametrize(
    "tags, kind",
    [
        ("Business, SOLO TRAVELER", "Solo"),
        ("Couple, Family Room", "Family"),
        ("Group of friends, Couple", "Group"),
        ("Couple", "Couple"),
        ("Solo traveler, Family", "Solo"),
        ("Travelers with friends", "Other"),
        ("", "Other"),
        (None, "Other"),
    ],
)
def test_traveller_type(frame, tags, kind):
    df = frame([(tags,)], "tags string")
    assert df.select(travellers.traveller_type(F.col("tags"))).first()[0] == kind


def test_traveller_satisfaction_minimum_is_strict(frame):
    df = frame(
        [("couple", 8.0)] * 51 + [("group", 6.0)] * 50 + [("family", 7.0)] * 51, "tags string, score double"
    )
    found = travellers.traveller_satisfaction(df)
    assert [(r["traveller"], r["n"]) for r in rows(found)] == [("Couple", 51), ("Family", 51)]
    assert rows(travellers.traveller_best_worst(found)) == [
        {"best": "Couple", "best_score": 8.0, "worst": "Family", "worst_score": 7.0}
    ]
    assert rows(travellers.traveller_best_worst(found.limit(0))) == []


# --- lengths ------------------------------------------------------------------------


def test_length_asymmetry_ratio_needs_three_positive_words(frame):
    df = frame(
        [(4.0, 6, 2), (4.0, 0, 3), (6.0, 6, 3), (8.0, 0, 0), (None, 30, 4), (9.0, 10, 6)],
        "score double, neg_words int, pos_words int",
    )
    found = {r["bucket_id"]: r for r in rows(lengths.length_asymmetry(df))}
    assert found[0]["neg_pos_ratio"] is None and found[0]["pct_has_neg"] == 50.0
    assert found[1]["neg_pos_ratio"] == 2.0
    assert found[2]["pct_has_pos"] == 0.0
    assert found[3]["n"] == 2 and found[3]["delta"] == 15.0
    assert sum(r["n"] for r in found.values()) == df.count()
    long = rows(lengths.length_long(lengths.length_asymmetry(df)))
    assert len(long) == 8 and {r["side"] for r in long} == {"positive", "negative"}
    verdict = rows(lengths.length_verdict(lengths.length_asymmetry(df)))[0]
    assert verdict["most_negative"].startswith(">= 9.0") and verdict["verdict"] == "venting"


def test_length_verdict_bound_is_strict_and_empty_stays_empty(frame):
    df = frame([(4.0, 13, 3)], "score double, neg_words int, pos_words int")
    table = lengths.length_asymmetry(df)
    assert rows(lengths.length_verdict(table))[0]["verdict"] == "balanced"
    assert rows(lengths.length_verdict(table.limit(0))) == []


# --- entities -------------------------------------------------------------------------


def priced(frame, groups):
    data = [(name, prior, score) for name, (prior, scores) in groups.items() for score in scores]
    return frame(data, "entity string, prior_score double, score double")


def test_score_reliability_minimum_is_inclusive(frame):
    df = priced(
        frame, {"few": (8.0, [5.0] * 99), "even": (8.0, [5.0] * 100), "wild": (8.0, [2.0, 10.0] * 50 + [None])}
    )
    found = rows(reliability.score_reliability(df))
    assert [(r["entity"], r["n"]) for r in found] == [("wild", 101), ("even", 100)]
    assert found[0]["cv"] == round(statistics.stdev([2.0, 10.0] * 50) / 6.0, 4)
    assert rows(reliability.score_reliability(df, top_k=1)) == found[:1]
    assert rows(reliability.score_reliability(df, min_count=1, top_k=9))[-1]["entity"] == "few"


def test_drop_null_score_leaves_unrated_reviews_out(frame):
    df = priced(frame, {"a": (8.0, [2.0, 10.0, None])})
    assert [r["n"] for r in rows(reliability.score_reliability(df, 1))] == [3]
    assert [r["n"] for r in rows(reliability.score_reliability(df, 1, drop_null_score=True))] == [2]
    assert [r["n"] for r in rows(gap.expectation_gap(df, drop_null_score=True))] == [2]
    assert [r["disaster_pct"] for r in rows(risk.hidden_risk(df, 1))] == [33.33]
    assert [r["disaster_pct"] for r in rows(risk.hidden_risk(df, 1, drop_null_score=True))] == [50.0]


def test_score_reliability_of_zero_mean_has_no_cv(frame):
    assert rows(reliability.score_reliability(priced(frame, {"z": (8.0, [0.0, 0.0])}), 2))[0]["cv"] is None


def test_hidden_risk_boundaries(frame):
    df = priced(
        frame,
        {
            "in": (8.0, [4.0] * 5 + [9.0] * 95),
            "too few": (8.0, [4.0] * 10 + [9.0] * 39),
            "low prior": (7.9999, [4.0] * 10 + [9.0] * 90),
            "fewer disasters": (8.0, [4.0] * 4 + [4.0001] + [9.0] * 95),
            "rounds up": (8.0, [4.0] * 999 + [9.0] * 18998),
        },
    )
    found = rows(risk.hidden_risk(df))
    assert [r["entity"] for r in found] == ["rounds up", "in"]
    inside = found[1]
    assert inside["disaster_pct"] == 5.0 and inside["disaster_count"] == 5
    assert inside["risk_index"] == round(5.0 * math.log1p(100), 2)
    assert inside["p05"] == 4.0
    assert [r["entity"] for r in rows(risk.hidden_risk(df, top_k=1))] == ["rounds up"]
    assert "low prior" in {r["entity"] for r in rows(risk.hidden_risk(df, min_prior=7.0))}


def test_expectation_gap_null_gap_counts_in_the_denominator_only(frame):
    df = priced(frame, {"a": (8.0, [7.0, 9.0, None, 7.5]), "b": (9.2, [9.5]), "c": (None, [5.0])})
    found = {r["bucket_id"]: r for r in rows(gap.expectation_gap(df))}
    assert found[1]["pct_below"] == 50.0 and found[1]["n"] == 4
    assert found[1]["mean_shortfall"] == -0.75
    assert found[3]["mean_shortfall"] == 0.0 and found[3]["n"] == 2
    assert set(r["bucket_id"] for r in rows(gap.expectation_gap(df, min_count=3))) == {1}


@pytest.mark.parametrize("second, verdict", [(-0.7, "more intense"), (-0.71, "similar")])
def test_gap_verdict(frame, second, verdict):
    gaps = frame([(0, "x", -1.0), (1, "y", second)], "bucket_id int, bucket string, mean_shortfall double")
    found = rows(gap.gap_verdict(gaps))[0]
    assert (found["harshest"], found["mildest"], found["verdict"]) == ("x", "y", verdict)
    assert rows(gap.gap_verdict(gaps.limit(0))) == []


def test_map_points_keep_whole_entities(frame):
    data = [(f"e{i % 40}", 1.0, 2.0, float(i % 10)) for i in range(4000)] + [("small", 1.0, 2.0, 9.0)] * 49
    df = frame(data, "entity string, lat double, lng double, score double")
    points = places.map_points(df)
    assert points.count() == 40
    half = rows(places.map_points(df, fraction=0.5))
    assert half == rows(places.map_points(df.repartition(3), fraction=0.5)) or sorted(
        r["entity"] for r in half
    ) == sorted(r["entity"] for r in rows(places.map_points(df.repartition(3), fraction=0.5)))
    assert 0 < len(half) < 40 and {r["n"] for r in half} == {100}
    assert rows(places.map_summary(points))[0]["n_reviews"] == 4000
    assert rows(places.map_summary(points.limit(0)))[0] == {
        "n_entities": 0, "mean_of_means": None, "n_reviews": 0,
    }
    assert len(rows(places.map_top(points))) == 5


def test_overview_and_preview(frame):
    df = frame([("b", 8.0), ("a", 7.0), ("a", None)], "entity string, prior_score double")
    assert rows(overview.dataset_overview(df)) == [{"n_reviews": 3, "avg_prior": 7.5, "n_entities": 2}]
    assert len(rows(overview.review_preview(df, columns=None, n=2))) == 2
    assert rows(overview.review_preview(df, columns=None, n=2, order=("entity", "prior_score"))) == [
        {"entity": "a", "prior_score": None}, {"entity": "a", "prior_score": 7.0},
    ]


# --- features ---------------------------------------------------------------------------


def feature_rows(frame):
    return frame(
        [
            ("h", 1.0, 2.0, 9.0, "NOISE and dirty", "nice", " A "),
            ("h", 1.0, 2.0, 5.9, "networks", "ok", "A"),
            ("h", 1.0, 2.0, None, None, "fine", None),
            ("h", 1.0, 2.0, 6.0, "rude staff", "", "A"),
        ],
        "entity string, lat double, lng double, score double, neg_text string, pos_text string, segment string",
    )


def test_entity_features(frame):
    found = rows(features.entity_features(feature_rows(frame)))[0]
    assert found["n_scores"] == 3 and found["pct_excellent"] == 25.0 and found["pct_negative"] == 25.0
    assert found["n_segments"] == 2  # untrimmed, null not counted
    assert found["pct_construction"] == 50.0  # no word boundary, so "networks" counts
    assert found["pct_cleanliness"] == 25.0 and found["pct_staff"] == 25.0
    neg = (15 + 8 + 10) / 3
    assert found["pos_neg_ratio"] == pytest.approx((4 + 2 + 4 + 0) / 4 / (neg + 1))
    assert found["mean_length"] == pytest.approx((19 + 10 + 10) / 3)
    approx = rows(features.entity_features(feature_rows(frame), approximate_segments=True))[0]
    assert approx["n_segments"] == 2


# --- skew and partitioning -----------------------------------------------------------------


def test_results_do_not_depend_on_partitioning_or_skew(spark):
    """One entity and segment hold a third of all rows."""
    base = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id") % 50)).alias("entity"),
        F.when(F.col("id") % 3 == 0, " hot ").otherwise(F.concat(F.lit("s"), F.col("id") % 20)).alias("segment"),
        (F.col("id") % 21 / 2).alias("score"),
        (7.0 + F.col("id") % 24 / 8).alias("prior_score"),
    )
    for run in (
        lambda df: segments.segment_severity(df),
        lambda df: risk.hidden_risk(df, min_prior=0.0),
        lambda df: gap.expectation_gap(df),
        lambda df: reliability.score_reliability(df),
    ):
        assert rows(run(base)) == rows(run(base.repartition(13, "entity"))) == rows(run(base.coalesce(1)))


def test_hidden_risk_keeps_a_null_entity(spark):
    rows = [(e, 9.0, 3.0 if i < 10 else 9.0) for e in (None, "a") for i in range(60)]
    reviews = spark.createDataFrame(rows, "entity string, prior_score double, score double")
    found = risk.hidden_risk(reviews).collect()
    assert [(r.entity, r.n, r.disaster_count, r.p05) for r in found] == [(None, 60, 10, 3.0), ("a", 60, 10, 3.0)]


def _scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_hidden_risk_reads_the_reviews_once(spark, tmp_path):
    rows = spark.range(3000).select(
        F.concat(F.lit("e"), F.col("id") % 3).alias("entity"), F.lit(9.0).alias("prior_score"), F.when(F.col("id") % 17 > 0, (F.col("id") * 7 % 19) / 2).alias("score")
    )
    rows.write.parquet(str(tmp_path / "reviews"))
    reviews = spark.read.parquet(str(tmp_path / "reviews"))
    for continuous in (False, True):
        assert _scans(risk.hidden_risk(reviews, continuous_scores=continuous)) == 1


@pytest.mark.parametrize("n", [1, 19, 20, 21, 39, 40, 41, 60, 140, 200])
def test_p05_is_the_smallest_score_with_a_twentieth_below(frame, n):
    draw = random.Random(n)
    scores = [draw.choice([None, *range(20)]) if i else 0 for i in range(n)]
    df = frame([("e", 9.0, None if s is None else float(s)) for s in scores], "entity string, prior_score double, score double")
    known = sorted(s for s in scores if s is not None)
    expected = known[max(0, -(-len(known) * 5 // 100) - 1)]
    for continuous in (False, True):
        found = risk.hidden_risk(df, min_count=1, min_disaster_pct=0.0, continuous_scores=continuous).first()
        assert found.p05 == expected and found.n == n
        assert found.mean_score == pytest.approx(sum(known) / len(known))
        assert found.disaster_count == sum(s <= 4 for s in known)


def test_hidden_risk_of_an_entity_without_scores(frame):
    df = frame([("e", 9.0, None)] * 60 + [("f", None, 1.0)] * 60, "entity string, prior_score double, score double")
    for continuous in (False, True):
        found = risk.hidden_risk(df, min_disaster_pct=0.0, continuous_scores=continuous).collect()
        assert [(r.entity, r.n, r.disaster_count, r.p05, r.mean_score) for r in found] == [("e", 60, 0, None, None)]


def test_equal_reviews_draw_apart_by_their_keys(frame):
    df = frame([(i, "e", 5.0, "the works were loud") for i in range(40)], "id int, entity string, score double, neg_text string")
    found = rows(keywords.keyword_samples(df, n=5, keys=("id",)))
    assert len({r["id"] for r in found}) == 5 and sorted(r["id"] for r in found) != [0, 1, 2, 3, 4]
    assert found == rows(keywords.keyword_samples(df.repartition(7), n=5, keys=("id",)))


def test_keyword_verdict_shows_both_sides(frame):
    impact = frame([(True, 6.0, 10, 0.2), (False, 7.0, 90, 0.1), (None, 5.0, 3, 0.5)], "has_keyword boolean, mean_score double, n long, ci95 double")
    assert rows(keywords.keyword_verdict(impact)) == [
        {"n_hit": 10, "n_other": 90, "mean_hit": 6.0, "mean_other": 7.0, "ci_hit": 0.2, "ci_other": 0.1, "diff": -1.0, "threshold": 0.3, "verdict": "strong"}
    ]


def test_keywords_are_searched_once(frame):
    df = frame([("the works", 5.0)], "neg_text string, score double")
    for found in (keywords.keyword_frequency(df), keywords.keyword_impact(df), keywords.keyword_summary(df)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("jackhammer") == 1  # the pattern's last word
