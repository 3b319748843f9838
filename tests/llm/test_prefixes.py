from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from opinara.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string, pos string, chars int, block string"


def brute(rows):
    """Every node's path as a tuple of turns."""
    whole = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            whole[c].append(((turn is not None, turn or 0), role or "", text or ""))
    turns = {c: [(role, text) for _, role, text in sorted(v)] for c, v in whole.items()}
    members = defaultdict(list)
    length = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt = turns.get(c - c % 100, [])[:h] + own[h:]
        length[c] = len(rebuilt)
        for d in range(len(rebuilt) + 1):
            members[tuple(rebuilt[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved, out = {}, {}, []
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in children[path]) or 1
        saved[path] = sum(saved[k] for k in children[path]) + ((len(members[path]) - 1) * len(path[-1][1]) if path else 0)
    for path, own in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in own if length[c] == len(path)))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(own), len(path), parent, len(own), len(children[path]), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, "b") for r in rows], SCHEMA).repartition(3)


def nodes(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def conversations(seed, n=260, turns=11, kinds=2):
    """Few different turns, so that conversations share beginnings of any length; some conversations are equal, some have no turn of their own left."""
    draw = random.Random(seed)
    ids = draw.sample([*range(150), *range(200, 330), 777, 1000, 10**12, 10**12 + 3], n)
    rows = []
    for c in ids:
        said = [("user", "hello é")] * draw.randint(0, 2) + [(draw.choice(["user", "assistant", None]), draw.choice(["yes", "no", "", None, "maybe " * 5][:kinds + 1])) for _ in range(draw.randint(1, turns))]
        rows += [(c, t, *s) for t, s in enumerate(said)]
    return rows


@pytest.mark.parametrize("seed, kinds", [(1, 1), (2, 2), (3, 4)])
def test_trie_equals_brute_force(spark, docs, seed, kinds):
    rows = conversations(seed, kinds=kinds)
    assert nodes(prefixes.rebuilt_trie(table(spark, rows))) == brute(rows)


def test_null_turns_ties_repeated_rows_and_null_ids(spark, docs):
    draw = random.Random(8)
    rows = [(c, draw.choice([None, 0, 1, 1, 5]), draw.choice(["a", "b", None]), draw.choice(["x", "y", None])) for c in (*range(40), None) for _ in range(draw.randint(1, 9))]
    rows += rows[:30]
    assert nodes(prefixes.rebuilt_trie(table(spark, rows))) == brute(rows)


def test_long_conversations_are_dealt_by_spans(spark, docs, monkeypatch):
    """Spans of four turns: running figures cross many of them, whatever the numbers of the turns."""
    monkeypatch.setattr(prefixes, "SPAN_BITS", 2)
    draw = random.Random(3)
    base = [("user", f"turn {i % 7}") for i in range(90)]
    rows = []
    for c in range(12):
        own = base[: draw.randint(60, 90)] + [("user", f"own {c % 3}")] * draw.randint(0, 20)
        rows += [(c, 10 * t - 200, *s) for t, s in enumerate(own)]
    assert nodes(prefixes.rebuilt_trie(table(spark, rows))) == brute(rows)


def test_a_third_of_all_conversations_are_equal(spark, docs, monkeypatch):
    monkeypatch.setattr(prefixes, "IDS_BITS", 3)  # the ids of the large group are joined from many parts
    rows = [(c, t, "user", f"{t}" if c % 3 == 0 else f"{t} {c % 50}") for c in range(400) for t in range(9)]
    assert nodes(prefixes.rebuilt_trie(table(spark, rows))) == brute(rows)


def test_conversations_without_turns_are_members_of_the_root(spark, docs):
    rows = [(c, 0, "user", "only") for c in range(101, 140)]  # no conversation 100, so the first h turns go and none comes
    found = nodes(prefixes.rebuilt_trie(table(spark, rows)))
    assert found == brute(rows)
    (root,) = [r for r in found if r[1] == 0]
    assert root[3] == 39 and root[2] is None


def test_one_very_long_text(spark, docs):
    rows = [(1, 0, "user", "é" * 500_000), (2, 0, "user", "é" * 500_000), (3, 0, "user", "x")]
    assert nodes(prefixes.rebuilt_trie(table(spark, rows))) == brute(rows)


def test_no_conversations(spark, docs):
    assert prefixes.rebuilt_trie(table(spark, [])).collect() == []
    assert prefixes.rebuilt_trie(table(spark, [(None, 1, "user", "x")])).collect() == []


def test_blocks_that_follow_alone_are_not_grouped_again(spark, docs):
    """One chain: the second grouping gets no row, and the nodes are right."""
    rows = [(100, t, "user", str(t)) for t in range(10)]
    found = prefixes.rebuilt_trie(table(spark, rows)).orderBy("depth").collect()
    assert [(r.depth, r.n_convs, r.n_children, r.n_leaves) for r in found] == [(d, 1, int(d < 10), 1) for d in range(11)]
