from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from opinara.llm import variants


def brute_counts(rows):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % 199 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            if len(low) >= 6:
                found[low] += 1
    return found


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute_near(words):
    near = defaultdict(set)
    for a in words:
        for b in words:
            if a < b and one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    return near


def brute_variants(counts, least=5, factor=5):
    n = {w: c for w, c in counts.items() if c >= least}
    near = brute_near(n)
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= factor * n[w]:
                form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, n[w], len(near[w]), form.get(w), n[form[w]] if w in form else None, root(w)) for w in n}


def rows_of(df):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def vocabulary(seed, n, letters="abé", least=6, most=9):
    draw = random.Random(seed)
    return sorted({"".join(draw.choices(letters, k=draw.randint(least, most))) for _ in range(n)})


@pytest.mark.parametrize("seed, letters, group", [(1, "abé", 5), (2, "ab", 2), (3, "abcdefgh", 1000), (4, "abcdefgh", 2)])
def test_all_near_pairs_are_found_whatever_the_group_size(spark, docs, seed, letters, group):
    words = vocabulary(seed, 150, letters)
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long").repartition(3)
    found = [(r.left, r.right) for r in variants.near_pairs(df, group).collect()]
    near = brute_near(words)
    assert sorted(tuple(sorted(p)) for p in found) == sorted((a, b) for a in near for b in near[a] if a < b)


def test_a_hot_chunk_is_refined_and_loses_nothing(spark, docs):
    """A third of the words share their first half, another third their second half."""
    draw = random.Random(4)

    def rest():
        return "".join(draw.choices("abcd", k=draw.randint(4, 5)))

    words = sorted({"prefix" + rest() for _ in range(120)} | {rest() + "suffix" for _ in range(120)} | set(vocabulary(9, 120, "xyz")))
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    near = brute_near(words)
    assert variants.near_pairs(df, 8).count() == sum(map(len, near.values())) // 2


def test_short_words_and_no_words(spark, docs):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("ab", 1), ("", 1), ("ba", 1), ("aba", 1)], "word string, n long")
    found = sorted(tuple(sorted((r.left, r.right))) for r in variants.near_pairs(df, 1).collect())
    assert found == [("a", "ab"), ("a", "b"), ("a", "ba"), ("ab", "aba"), ("ab", "b"), ("aba", "ba"), ("b", "ba")]


def corpus(seed):
    draw = random.Random(seed)
    words = vocabulary(seed, 60, "abÀé", 5, 8) + ["Correct", "corect", "corrct", "CORRECT", "naïveté", "ÉTÉÉTÉ", "étéété"]
    texts = [" ".join(draw.choices(words, [1 + 40 * (w.lower() == "correct") for w in words], k=60)) + draw.choice([".", "\n", " x1y×÷z"]) for _ in range(120)]
    rows = [(i % 100, t) for i, t in enumerate(texts)] + [(None, "correct nullid correct"), (7, None), (8, ""), (9, "123 !!"), (10, "correct " * 3000), (10, "correct " * 3000)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_equal_brute_force(spark, docs, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "en", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(4)
    expected = brute_variants(brute_counts(rows))
    assert rows_of(variants.spelling_variants(df)) == rows_of(variants.spelling_variants(df, group=3)) == expected
    assert any(form for *_, form, _, _ in expected)


def test_long_texts_are_cut_between_runs(monkeypatch):
    text = "word" * 3 + " one\ntwo-three " + "x" * 50 + " end"
    for size in (1, 5, 30, 1000):
        parts = list(variants._slices(text, size))
        assert "".join(parts) == text
        assert sum((re.findall("[A-Za-z]+", p) for p in parts), []) == re.findall("[A-Za-z]+", text)


def test_chains_of_forms_end_at_their_root(spark, docs):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "zzzzzz": 9}
    text = " ".join(f"{w} " * n for w, n in counts.items())
    found = {r.word: (r.form, r.root) for r in variants.spelling_variants(spark.createDataFrame([(1, text)], "doc_id long, text string"), every=10**12).collect()}
    assert found == {"aaaaaa": ("aaaaab", "aaabbb"), "aaaaab": ("aaaabb", "aaabbb"), "aaaabb": ("aaabbb", "aaabbb"), "aaabbb": (None, "aaabbb"), "zzzzzz": (None, "zzzzzz")}


def test_nothing(nothing):
    assert variants.spelling_variants(nothing).count() == 0
