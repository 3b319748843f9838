from __future__ import annotations

import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from checks.compare import connect, difference
from opinara.llm import chaining, durable, oracles, ranking, registry, secrets
from opinara.llm.rowkeys import REPEATED, row_keyed

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables missing")


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_matches_sql(spark, name):
    with connect(SF_DIR) as db:
        assert difference(registry.QUERIES[name](spark, SF_DIR), db, oracles.ORACLES[name]) is None


def test_stages_take_effect(spark, tmp_path):
    docs = registry.table(spark, SF_DIR, "documents")
    before = {r.doc_id: r.text for r in docs.collect()}
    kinds, kept = docs.dtypes, [len(before)]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        if number < 4:
            assert docs.dtypes == kinds
            kept.append(docs.count())
    assert kept == sorted(kept, reverse=True) and kept[1] < kept[0] and kept[4] > kept[0] // 2
    packed = docs.collect()
    assert {r.doc_id for r in packed} <= set(before) and len({r.doc_id for r in packed}) == kept[4]
    assert max(r.offset + r.length for r in packed) <= 2048


CLASHING = "doc_id long, text string, lang string, source string, n_chars long, cut string, doc string, row_key string, cuts int, several int, own_0 string, n_words long, symbols double, part long, g long, label long, spans string"


def clashing(spark, rows):
    """Documents beside columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", -1, "c", "d", "k", 1, 2, "o", 3, 0.5, 4, 5, 6, "x") for i, t in rows], CLASHING).repartition(3)


def prose_of(seed, n):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))


X, Y, Z = prose_of(1, 80), prose_of(2, 80), prose_of(3, 80)
NEAR_X = " ".join([*X.split()[:-2], "other", "end"])
ROWS = [(1, X), (2, X), (2, Y), (3, NEAR_X), (4, Z), (4, Z), (5, f"{prose_of(4, 30)} {' '.join(Z.split()[:60])} {prose_of(5, 30)}"), (6, None), (7, ""), (8, "short"), (None, X), (None, None), (9, prose_of(6, 20_000))]


def bag(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_classifier_stage_judges_each_row_by_its_text(spark, docs, monkeypatch):
    """A ranker that knows only whether a text has 50 words: rows of one id part, and rows without an id are judged too."""
    names = list(ranking.features())
    weights = np.array([-1.0 if n == "short" else 0.0 for n in names])
    fixed = ranking.Ranker(np.zeros(len(names)), np.ones(len(names)), weights, -float(np.exp(-50 / 30)))
    monkeypatch.setattr(ranking, "fitted", lambda *args: fixed)
    rows = [*ROWS, (1, "too short"), (10, prose_of(7, 50)), (11, prose_of(8, 49))]
    df = clashing(spark, rows)
    out = corpus_pipeline.quality_classifier(spark, df, SF_DIR)
    assert out.dtypes == df.dtypes
    assert bag(out) == Counter((i, t) for i, t in rows if len((t or "").split()) >= 50)


def test_join_stage_keeps_one_of_each_group_by_row(spark, docs):
    df = clashing(spark, ROWS)
    out = corpus_pipeline.ngram_jaccard_join(spark, df, SF_DIR)
    # of X, its copy under the id 2 and its near copy the first stays; Y, also of id 2, is nobody's copy
    gone = Counter([(2, X), (3, NEAR_X)])
    assert out.dtypes == df.dtypes and bag(out) == Counter(ROWS) - gone


def test_dedup_stage_cuts_by_row(spark, docs):
    df = clashing(spark, ROWS)
    out = corpus_pipeline.substring_dedup(spark, df, SF_DIR)
    found = bag(out)
    assert out.dtypes == df.dtypes
    assert found[2, Y] == 1 and found[1, X] == 1 and found[4, Z] == 2 and found[None, X] == 1 and found[None, None] == 1 and found[7, ""] == 1 and found[6, None] == 1
    assert not any(i == 2 and t != Y for i, t in found)  # the copy of X under the id 2 is cut out whole and goes
    (cut,) = [t for i, t in found if i == 5]
    assert cut.split() == (prose_of(4, 30) + " " + prose_of(5, 30)).split()
    assert len(out.where("doc_id = 3").collect()) <= 1
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out.collect())


def test_text_that_repeats_itself_is_cut_by_few_passages(spark, docs, monkeypatch):
    """Words said over and over are a passage from each place; the stage needs as many as hold the words."""
    rng = random.Random(8)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    rows = [(i, f"{fresh(30)} {'over again ' * (30 if i == 0 else 100)}{fresh(30)}") for i in range(6)]
    df, kept, cut = clashing(spark, rows), [], corpus_pipeline.without_passages
    monkeypatch.setattr(corpus_pipeline, "without_passages", lambda keyed, found, **more: kept.append(found.cache()) or cut(keyed, kept[0], **more))
    out = bag(corpus_pipeline.substring_dedup(spark, df, SF_DIR))
    assert kept[0].count() <= 5 * 2 * 200 // 45
    every = chaining.repeated_passages(df.select("doc_id", "text"))
    assert out == bag(cut(df, every, keep_empty=False)) and every.count() > 5 * 50


def test_secret_stage_masks_every_row(spark, docs):
    secret = 'db_password = "Zk8vQ2xP9wLm4T7a"'
    rows = [*ROWS, (1, secret), (1, secret), (None, secret)]
    df = clashing(spark, rows)
    out = corpus_pipeline.secret_scans(spark, df, SF_DIR)
    expected = Counter((i, t if t is None else secrets.mask(t, secrets.scan(t))) for i, t in rows)
    assert out.dtypes == df.dtypes and bag(out) == expected and not any("Zk8v" in (t or "") for _, t in expected)


def test_packing_stage_has_every_token_once(spark, docs):
    out = corpus_pipeline.best_fit_packing(spark, clashing(spark, ROWS), SF_DIR).collect()
    by_place = defaultdict(list)
    for r in out:
        by_place[r.sequence_id].append((r.offset, r.length))
    for pieces in by_place.values():
        ends = np.cumsum([n for _, n in sorted(pieces)]).tolist()
        assert [at for at, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert sum(r.piece == 0 for r in out) == len(ROWS)


@pytest.mark.parametrize("number", range(5))
def test_stages_of_an_empty_table(spark, docs, number):
    name, stage = corpus_pipeline.STAGES[number]
    empty = clashing(spark, [])
    out = stage(spark, empty, SF_DIR)
    assert out.collect() == [] and (number == 4 or out.dtypes == empty.dtypes), name


def test_row_keys(spark, docs):
    df = clashing(spark, ROWS)
    keyed, name = row_keyed(df)
    assert name == "row_key_" and keyed.columns == [*df.columns, name]
    keys = {}
    for r in keyed.collect():
        keys.setdefault((r.doc_id, r.text), set()).add(r[name])
    assert all(len(k) == 1 for k in keys.values())
    values = {pair: k.pop() for pair, k in keys.items()}
    assert all(v == i for (i, _), v in values.items() if i != 2)
    assert len({v for (i, _), v in values.items() if i == 2}) == 2 and all(v >= REPEATED for (i, _), v in values.items() if i == 2)


def test_no_shared_folder_on_a_cluster_is_an_error(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        durable.ready(Session())


def test_stored_tables_leave_no_shuffles(spark, tmp_path):
    """Shuffles of what is kept whole took more disk than the budget until the driver's memory was next tidied up; the caller's setting stays."""
    shuffles = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses()
    known = set(map(str, spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(shuffles.keySet())))
    before = spark.conf.get(durable.CLEANUP, None)
    for keep in (durable.stored, durable.written):
        kept = keep(spark.range(1000).repartition(3).groupBy((durable.F.col("id") % 7).alias("k")).count())
        after = set(map(str, spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(shuffles.keySet())))
        assert after <= known and sum(r["count"] for r in kept.collect()) == 1000
        known |= set(map(str, spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(shuffles.keySet())))
    assert spark.conf.get(durable.CLEANUP, None) == before
