from __future__ import annotations

import hashlib
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.llm import chaining, components, partenum, suffixes

LAST = 1 << 62


def brute_removal(rows, length):
    texts = [(LAST if i is None else i, (t or "").encode()) for i, t in rows]
    least = {}
    for d, t in texts:
        for i in range(len(t) - length + 1):
            k = t[i : i + length]
            least[k] = min(least.get(k, d), d)
    out = Counter()
    for (i, _), (d, t) in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 2, bool)
        for p in range(len(t) - length + 1):
            if least[t[p : p + length]] < d:
                gone[p + 1 : p + length + 1] = True
        kept = bytes(b for b, g in zip(t, gone[1:-1], strict=True) if not g)
        out[i, len(t), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("length", [50, 20])
def test_removal_equals_brute_force(docs, length):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = suffixes.remove_repeats(docs, length=length)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()) == brute_removal(rows, length)


@pytest.mark.parametrize("seed", range(3))
def test_removal_on_repetitive_texts(spark, docs, seed):
    rng = random.Random(seed)
    rows = [(i % 20, "".join(rng.choice(("ab", "aab", "é", "x" * 60)) for _ in range(rng.randint(0, 60)))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffixes.remove_repeats(df)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()) == brute_removal(rows, 50)


def test_nothing_to_remove(nothing):
    assert suffixes.remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_expansion_finds_short_common_prefixes(seed):
    rng = np.random.default_rng(seed)
    n, least = int(rng.integers(20, 800)), int(rng.integers(1, 15))
    text = rng.choice(np.frombuffer(b"abc", np.uint8), n)
    order = suffixes.rotations(text, least)
    heads = [np.roll(text, -i)[:least].tobytes() for i in order]
    assert heads == sorted(heads)
    assert suffixes.shared_prefixes(text, order, least).tolist() == [True] + [a != b for a, b in zip(heads, heads[1:], strict=False)]


def shingle_set(text, size):
    found = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} if len(found) >= size else {tuple(found)} - {()}


def brute_groups(rows, size, percent):
    sets = [(i, shingle_set(t, size)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if i is not None and j is not None and x & y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return Counter((i, len(x), None if i is None else root(i)) for i, x in sets)


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_groups_equal_brute_force(docs, size, percent):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = partenum.similar_groups(docs, shingle=size, percent=percent)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute_groups(rows, size, percent)


def test_many_near_copies_on_both_sides_of_the_limit(spark, docs):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(120)] = f"n{rng.randrange(1000)}"
        rows.append((i, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = partenum.similar_groups(df, shingle=3, percent=90)
    assert Counter(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect())) == brute_groups(rows, 3, 90)


@pytest.mark.parametrize("percent", [80, 90])
def test_similar_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    bands = partenum.Bands(percent)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        whole = rng.integers(0, 1 << 63, n).astype(np.uint64)
        most = n * (100 - percent) // 100
        a, b = whole.copy(), whole[int(rng.integers(0, most + 1)) :]
        row = np.concatenate([np.zeros(len(a), np.int64), np.ones(len(b), np.int64)])
        owner, found = partenum.signatures(row, np.concatenate([a, b]), np.array([len(a), len(b)]), bands)
        assert set(found[owner == 0].tolist()) & set(found[owner == 1].tolist())


def test_no_groups(nothing):
    assert partenum.similar_groups(nothing).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, docs, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(12)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}


@pytest.mark.parametrize("seed", range(20))
def test_chain_score_is_the_best(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(2, 9))
    x, y = rng.integers(0, 60, n), rng.integers(0, 60, n)
    worth, cost = 5.0, 0.05

    def best(i, seen={}):
        return worth + max([0.0] + [best(j) - cost * (x[i] - x[j] + y[i] - y[j]) for j in range(n) if x[j] < x[i] and y[j] < y[i]])

    def score(path):
        steps = sum(cost * (x[b] - x[a] + y[b] - y[a]) for a, b in zip(path, path[1:], strict=False))
        return worth * len(path) - steps

    found = chaining.chain(x, y, worth, cost)
    assert all((np.diff(x[p]) > 0).all() and (np.diff(y[p]) > 0).all() for p in found)
    expected = max(best(i) for i in range(n))
    assert abs(max([worth] + [score(p) for p in found]) - expected) < 1e-9


def test_passages_are_found(docs, nothing):
    rows = chaining.repeated_passages(docs).collect()
    pairs = {(r.doc_id, r.source_id) for r in rows}
    assert {(31, 3), (34, 5), (35, 5), (33, 4)} <= pairs
    assert (32, 3) in pairs or (32, 31) in pairs  # a copy may name a copy, which names the first
    # documents 1 to 30 and 40 are written apart, but for 44, which is 8 and 9, and 40, whose prose begins like 7
    assert {d for d, _ in pairs} <= {31, 32, 33, 34, 35, 40, 44}
    own = {r.doc_id: r for r in rows if r.doc_id == 34}[34]
    assert own.start_word == 40 and own.n_words == 60 and own.equal_share == 1.0
    assert chaining.repeated_passages(nothing).count() == 0


def test_a_passage_with_changes_is_found(spark, docs):
    rng = random.Random(2)
    base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
    changed = [w if i % 17 else "other" for i, w in enumerate(base)]
    changed.insert(50, "inserted")
    rows = [(1, " ".join(base)), (2, "a b c " + " ".join(changed)), (3, " ".join(f"z{rng.randrange(10**6)}" for _ in range(200)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = chaining.repeated_passages(df)
    (row,) = found.collect()
    assert (row.doc_id, row.source_id) == (2, 1) and row.n_words >= 95 and row.equal_share > 0.9
    kept = {r.doc_id: r.text for r in chaining.without_passages(df, found).collect()}
    assert kept[1] == rows[0][1] and kept[3] == rows[2][1] and len(kept[2].split()) <= 9


@pytest.mark.parametrize("seed", range(3))
def test_exact_passages_are_found_whatever_holds_their_parts(spark, docs, seed):
    rng = random.Random(seed)

    def fresh(n):
        return [f"w{rng.randrange(10**9)}" for _ in range(n)]

    rows, halves = [], [fresh(rng.randrange(23, 45)) for _ in range(60)]
    for i, half in enumerate(halves):  # the parts, each in a smaller document of its own
        rows.append((i, fresh(20) + half + fresh(20)))
    for i in range(0, 60, 2):
        for j in range(2):
            rows.append((100 + i + j, fresh(rng.randrange(30)) + halves[i] + halves[i + 1] + fresh(rng.randrange(30))))
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string").repartition(5)
    covered = {(r.doc_id, w) for r in chaining.repeated_passages(df).collect() for w in range(r.start_word, r.start_word + r.n_words)}
    held, missed = {}, set()
    for i, t in sorted(rows):
        for at in range(len(t) - 44):
            if held.setdefault(tuple(t[at : at + 45]), i) < i:
                missed |= {(i, w) for w in range(at, at + 45)} - covered
    assert not missed


def test_changed_words_near_the_ends_do_not_shorten_a_passage():
    a = np.arange(100, dtype=np.uint32)
    b = a.copy()
    b[[*range(25), 28, 71, *range(75, 100)]] += 1000  # words 25 to 74 are a passage, its words 4 and 47 changed
    for x in (np.array([40]), np.array([35, 60])):
        ((x0, x1, y0, y1, found),) = chaining.align(a, b, x, x, 45, 0.8)
        assert 25 <= x0 == y0 and y1 == x1 <= 75 and x1 - x0 >= 45 and found >= 45 / 47


def changed_passages(percent, n_words, n=100):
    """Pairs of documents that share a passage of which so many words are changed, at random."""
    rng = random.Random(1000 * n_words + percent)

    def fresh(n):
        return [f"w{rng.randrange(10**9)}" for _ in range(n)]

    for i in range(n):
        base = fresh(n_words)
        other = list(base)
        for j in rng.sample(range(1, n_words - 1), n_words * percent // 100):
            other[j] = f"changed{rng.randrange(10**9)}"
        yield from (fresh(30) + base + fresh(30), fresh(30) + other + fresh(30))


def test_recall_of_changed_passages(spark, docs):
    kinds = [(10, 60, 99), (15, 60, 93), (20, 60, 60), (10, 100, 100), (20, 100, 80)]  # percent changed, words, least found of 100
    rows = [" ".join(t) for percent, n, _ in kinds for t in changed_passages(percent, n)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id for r in chaining.repeated_passages(df).collect() if r.source_id == r.doc_id - 1}
    counts = [sum(200 * k < d < 200 * (k + 1) for d in found) for k in range(len(kinds))]
    print("found of 100:", counts)
    assert all(c >= least for c, (_, _, least) in zip(counts, kinds, strict=True)), counts


PART_KINDS = [(10, 100, 20), (10, 100, 30), (20, 100, 20), (20, 100, 30), (10, 60, 20), (10, 60, 30)]  # percent changed, words, words of a part


def held_in_parts(n=60):
    """For each kind ``n`` passages and changed copies of them, whose parts all have smaller documents of their own as well."""
    rng, parts, pairs = random.Random(77), [], []

    def fresh(n):
        return [f"w{rng.randrange(10**9)}" for _ in range(n)]

    for kind, (percent, n_words, part) in enumerate(PART_KINDS):
        for _ in range(n):
            base = fresh(n_words)
            other = list(base)
            for j in rng.sample(range(1, n_words - 1), n_words * percent // 100):
                other[j] = f"changed{rng.randrange(10**9)}"
            parts += [fresh(10) + base[at : at + part] + fresh(10) for at in range(0, n_words, part)]
            pairs.append((kind, fresh(30) + base + fresh(30), fresh(30) + other + fresh(30)))
    return parts, pairs


def test_recall_where_parts_have_other_holders(spark, docs):
    parts, pairs = held_in_parts()
    rows = [" ".join(p) for p in parts] + [" ".join(t) for _, *both in pairs for t in both]
    first = len(parts)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id for r in chaining.repeated_passages(df).collect() if r.doc_id >= first and (r.doc_id - first) % 2 == 1 and r.source_id == r.doc_id - 1}
    counts = Counter(kind for i, (kind, *_) in enumerate(pairs) if first + 2 * i + 1 in found)
    print("found of 60:", [counts[k] for k in range(len(PART_KINDS))])
    assert all(counts[k] >= 54 for k in range(len(PART_KINDS)))


def test_recall_where_the_first_and_the_last_holders_of_all_parts_are_others(spark, docs):
    parts, pairs = held_in_parts(20)
    rng = random.Random(78)
    again = [[f"w{rng.randrange(10**9)}" for _ in range(10)] + p[10:-10] + [f"w{rng.randrange(10**9)}" for _ in range(10)] for p in parts]
    rows = [*parts, *(base for _, base, _ in pairs), *again, *(other for _, _, other in pairs)]
    step = len(pairs) + len(again)
    df = spark.createDataFrame(list(enumerate(" ".join(r) for r in rows)), "doc_id long, text string")
    found = {r.doc_id for r in chaining.repeated_passages(df).collect() if r.source_id == r.doc_id - step}
    counts = Counter(kind for i, (kind, *_) in enumerate(pairs) if len(parts) + step + i in found)
    print("found of 20:", [counts[k] for k in range(len(PART_KINDS))])
    assert all(counts[k] >= 18 for k in range(len(PART_KINDS)))


def test_the_many_holders_of_a_line_get_few_links():
    """A place of a near copy leads to some others; where all words but the line differ, hardly one does."""
    rng = np.random.default_rng(5)
    n, width, line = 600, 100, rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    base = rng.integers(0, 1 << 63, width, dtype=np.uint64)
    near = np.where(rng.random((n, width)) < 0.05, rng.integers(0, 1 << 63, (n, width), dtype=np.uint64), base)
    for texts, least, most in ((near, n - 1, 20 * n), (rng.integers(0, 1 << 63, (n, width), dtype=np.uint64), 0, n // 2)):
        texts[:, 44:56] = line
        hashes, row, at = texts.ravel(), np.repeat(np.arange(n), width), np.arange(n) * width + 46
        seed, size = np.zeros(n, np.int64), chaining.SEED_WORDS
        around = chaining.beside(hashes, row, at, size), chaining.farther(hashes, at, size), chaining.farther(hashes, at, size, 12)
        rows, to = chaining.others(seed, np.arange(n), *around, np.zeros(n, bool), least=45, share=0.8)
        assert (to < rows).all() and len(rows) < most and len(np.unique(rows)) >= least


def holders_of_a_line(n, planted, changed, seed=3):
    """Word hashes of texts that share 12 words in the middle and little else; of every ``planted``-th, 50 words around these are an earlier text's, a part of them changed."""
    rng = np.random.default_rng(seed)
    texts = rng.integers(0, 500, (n, 100)).astype(np.uint64)
    pairs = []
    for k in range(n // 2, n, planted):
        source = int(rng.integers(0, n // 2))
        start = int(rng.integers(8, 42))
        texts[k, start : start + 50] = np.where(rng.random(50) < changed, texts[k, start : start + 50], texts[source, start : start + 50])
        pairs.append((k, source))
    texts[:, 44:56] = np.arange(1000, 1012)
    return chaining.mix(texts), pairs


def links_of_a_line(texts, with_words):
    n, width = texts.shape
    hashes, row, at, size = texts.ravel(), np.repeat(np.arange(n), width), np.arange(n) * width + 46, chaining.SEED_WORDS
    around = chaining.beside(hashes, row, at, size), chaining.farther(hashes, at, size), chaining.farther(hashes, at, size, 12)
    wide = (np.arange(n), chaining.wider(hashes, row, at, size, np.arange(n))) if with_words else None
    return chaining.others(np.zeros(n, np.int64), np.arange(n), *around, np.zeros(n, bool), least=45, share=0.8, wide=wide)


@pytest.mark.parametrize("sought", [256, 1 << 17])
def test_places_of_a_hot_seed_are_looked_up(monkeypatch, sought):
    """By their words, the same passages are found as by comparing all."""
    monkeypatch.setattr(chaining, "SURE", 1e-300)
    monkeypatch.setattr(chaining, "SOUGHT", sought)
    texts, pairs = holders_of_a_line(4000, 10, 0.1)
    every, found = ({*zip(*(c.tolist() for c in links_of_a_line(texts, w)), strict=True)} for w in (False, True))
    assert found <= every and len(found) < 1.1 * len(pairs)
    real = set()
    for i, j in every:
        same = (texts[i] == texts[j])[6:91]  # the words in sight; the seed's are those from 40 to 44
        total = np.concatenate([[0], np.cumsum(same - 0.8)])
        if any(same[a] and same[b - 1] and total[b] - total[a] >= -1e-6 for a in range(41) for b in range(a + 45, 86)):
            real.add((i, j))
    assert len(real) > 0.9 * len(pairs) and real <= found


def test_links_of_a_hot_seed_grow_with_its_places():
    counts = [len(links_of_a_line(holders_of_a_line(n, n, 0.0)[0], True)[0]) for n in (1500, 6000)]
    assert max(counts) <= 3


def test_hot_seeds_change_no_passage(spark, docs, monkeypatch):
    texts, pairs = holders_of_a_line(700, 5, 0.1)
    df = spark.createDataFrame([(i, " ".join(f"w{v:x}" for v in t.tolist())) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    before = {tuple(r) for r in chaining.repeated_passages(df).collect()}
    monkeypatch.setattr(chaining, "HOT", 200)
    seen = []
    plain = chaining._send
    monkeypatch.setattr(chaining, "_send", lambda *args: seen.append(len(args[-1])) or plain(*args))
    assert {tuple(r) for r in chaining.repeated_passages(df).collect()} == before
    assert seen[0] and len({r[1:3] for r in before}) >= 1 and len({r[0] for r in before} & {k for k, _ in pairs}) > 0.9 * len(pairs)


def test_a_block_of_documents_is_compared_by_one_sorting():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    sets = [np.unique(np.where(rng.random(300) < rng.choice([0.02, 0.3]), rng.integers(0, 1 << 63, 300, dtype=np.uint64), base)) for _ in range(1024)]
    rows = [(i, int(rng.integers(0, 300)), s) for i, s in enumerate([*sets[:-2], base[:0], base[:0]])]
    left, right = rows[::2], rows[1::2]
    began = time.process_time()
    found = list(partenum._links(left, right, 80))
    assert time.process_time() - began < 2
    expected = []
    for i, label, own in left[::16]:
        met = {label}
        for j, its, other in right:
            both = len(np.intersect1d(own, other))
            if both and 100 * both >= 80 * (len(own) + len(other) - both) and its not in met:
                met.add(its)
                expected.append((i, j))
    assert expected and [p for p in found if p[0] % 32 == 0] == expected
    assert list(partenum._links(left, [], 80)) == list(partenum._links([], right, 80)) == []


@pytest.mark.parametrize("share", [0.5, 0.7, 0.85])
def test_no_link_is_denied_by_its_misses(share):
    """What is ``promising`` is ``roomy``."""
    rng = np.random.default_rng(int(share * 100))
    hashes = rng.integers(0, 1 << 63, (2, 400, 95), dtype=np.uint64)
    hashes[1] = np.where(rng.random((400, 95)) < share, hashes[0], hashes[1])
    hashes[1, :, 45:50] = hashes[0, :, 45:50]
    row, at, size = np.repeat(np.arange(400), 95), np.arange(400) * 95 + 45, chaining.SEED_WORDS
    near, far = (np.bitwise_xor(*(f(h.ravel()) for h in hashes)) for f in (lambda h: chaining.beside(h, row, at, size), lambda h: chaining.farther(h, at, size)))
    roomy = chaining.roomy(*chaining.misses(near, far), size, 45, 0.8)
    assert not (chaining.promising(near, far, size, 45, 0.8) & ~roomy).any()
    assert share > 0.6 or not roomy.all()


def test_cut_takes_words_and_keeps_the_rest():
    assert chaining.cut("a  bé c\nd", [(1, 2)]) == "a\nd"
    assert chaining.cut("a b", [(0, 5)]) == ""
    assert chaining.cut("a b c", [(0, 1), (0, 2)]) == "c"


@pytest.mark.parametrize("seed", range(200))
def test_spans_that_cover_leave_no_word_out(seed):
    rng = random.Random(seed)
    start = [rng.randrange(30) for _ in range(rng.randrange(9))]
    end = [a + rng.randrange(1, 10) for a in start]
    kept = chaining.covering(start, end)
    held = Counter(w for i in kept for w in range(start[i], end[i]))
    assert set(held) == {w for a, b in zip(start, end, strict=True) for w in range(a, b)} and max(held.values(), default=0) <= 2


def test_rows_keep_their_columns(docs):
    out = chaining.without_passages(docs, chaining.repeated_passages(docs))
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where(F.col("text").isNull()).count() == docs.where(F.col("text").isNull()).count()


def test_chains_of_two_documents_travel_as_one_row(spark, docs, monkeypatch):
    """A line that documents repeat makes a chain for each of its places; their rows grow with pairs of documents."""
    rng = random.Random(5)
    line, n, times = " ".join(f"w{rng.randrange(10**9)}" for _ in range(50)), 12, 8
    rows = [(i, " ".join(f"{line} x{i}y{j} x{i}z{j}" for j in range(times))) for i in range(n)]
    kept = []
    monkeypatch.setattr(chaining, "stored", lambda df: kept.append(df.cache()) or kept[-1])
    found = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    covered = {(r.doc_id, w) for r in found for w in range(r.start_word, r.start_word + r.n_words)}
    assert all((i, 52 * j + w) in covered for i in range(1, n) for j in range(times) for w in range(50))
    assert kept[0].count() <= 2 * (n - 1)


def test_a_phrase_alone_asks_for_no_text(spark, docs, monkeypatch):
    """Documents that share twelve words and no more are told apart by what the seeds carry."""
    rng = random.Random(6)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    phrase = fresh(12)
    rows = [(i, f"{fresh(60)} {phrase} {fresh(60)}") for i in range(40)]
    kept = []
    monkeypatch.setattr(chaining, "stored", lambda df: kept.append(df.cache()) or kept[-1])
    assert chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0
    chains = sum(len(r["at"]) // 4 for r in kept[0].collect())  # two links at most of each document, one seed or more in each
    assert chains <= 39 * 2 * 12 and sum(len(r["at"]) == 4 for r in kept[0].collect()) == 0


@pytest.mark.parametrize("share", [0.0, 0.6, 0.8, 0.9])
def test_no_passage_is_denied_by_what_its_seed_carries(share):
    """Brute force over all passages through a seed, in texts that end near it too, against the bits alone."""
    rng = np.random.default_rng(int(share * 10))
    size, least, limit, promised = chaining.SEED_WORDS, 45, 0.8, 0
    for _ in range(150):
        n = int(rng.integers(45, 160))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n).astype(np.uint64)
        at = int(rng.integers(0, n - size + 1))
        same = rng.random(n) < share
        same[at : at + size] = True
        b = np.where(same, a, rng.integers(0, 1 << 63, n, dtype=np.uint64))
        total = np.concatenate([[0], np.cumsum(same)])
        lo, hi = max(0, at - least), min(n, at + size + least)
        real = any(j - i >= least and total[j] - total[i] >= limit * (j - i) for i in range(lo, at + 1) for j in range(at + size, hi + 1))
        seen = []
        for text, others in ((a, 60), (b, 70)):  # other texts of the chunk before and after
            around = rng.integers(0, 1 << 63, 2 * others, dtype=np.uint64)
            hashes, row = np.concatenate([around[:others], text, around[others:]]), np.repeat([0, 1, 2], [others, n, others])
            seen.append((chaining.beside(hashes, row, np.array([others + at]), size), chaining.farther(hashes, np.array([others + at]), size)))
        said = bool(chaining.promising(seen[0][0] ^ seen[1][0], seen[0][1] ^ seen[1][1], size, least, limit)[0])
        assert said or not real
        promised += said
    assert share or promised == 0
