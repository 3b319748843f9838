"""Registered queries against their SQL, and the shape of their plans."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.registry import QUERIES
from checks.sql import ORACLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables missing")


@pytest.fixture(scope="module")
def db():
    with connect(SF_DIR) as connection:
        yield connection


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    assert difference(df, db, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_plans_stay_in_the_jvm_and_pair_nothing(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    pairs = "" if name == "sentiment_metrics" else "CartesianProduct|BroadcastNestedLoopJoin|"  # there one row meets one row
    assert not re.search(pairs + r"PythonUDF|EvalPython|MapInPandas", plan)


@pytest.mark.parametrize(
    "name, tables",
    [
        ("hidden_risk", {"lineitem", "supplier"}),
        ("traveller_satisfaction", {"lineitem", "supplier"}),
        ("segment_severity", {"lineitem", "orders", "customer", "nation", "supplier"}),
    ],
)
def test_only_needed_tables_and_columns_are_read(spark, name, tables):
    plan = plan_of(QUERIES[name](spark, SF_DIR)).split("== Physical Plan ==")[1]
    assert set(re.findall(r"/(\w+)\.parquet", plan)) == tables
    assert "l_extendedprice" not in plan and "doc_text" not in plan


def test_examples_rank_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(QUERIES["region_profile_examples"](spark, SF_DIR))


def test_top_k_needs_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["keyword_samples"](spark, SF_DIR))


def test_entry_and_keys(spark):
    assert contract.entry(spark).count() > 0
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", ["review_preview", "review_preview_all_columns"])
def test_preview_cuts_before_it_joins_texts(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR)).split("== Physical Plan ==")[1]
    cut = next(line for line in plan.splitlines() if "TakeOrderedAndProject" in line)
    assert "text" not in cut


def test_text_join_shuffles_reviews_once(spark):
    from opinara.sources import star

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(star.reviews(spark, SF_DIR, ("neg_text",))).split("== Physical Plan ==")[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "RoundRobin" not in plan
    assert len(re.findall(r"Exchange hashpartitioning\(doc_key", plan)) == 1
