"""Quality classifier by Bradley-Terry pairwise ranking.

Documents get a score from their text figures; the chance that a document labelled good beats one labelled bad
is the logistic of their score difference.  The score is the linear function that makes the seen preferences
likeliest, and a quantile of the training scores is the threshold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.durable import stored
from opinara.llm.rules import share, text_measures, with_measures

BLOCK = 4096  # rows of one kind that stand in a block
LEAST = 64  # rows of either kind that a block should have
ROWS = 256  # good rows compared at once with a block's bad ones


def features() -> dict[str, Column]:
    """Figures of a text, none of them growing without bound with its length."""

    def root(part: str, whole: str) -> Column:
        return F.sqrt(F.least(share(part, whole), F.lit(4.0)))

    return {
        "symbols": root("n_symbols", "n_words"),
        "upper": root("n_upper", "n_chars"),
        "repeats": root("n_repeat_words", "n_words"),
        "lines": root("n_dup_lines", "n_lines"),
        "stops": root("n_stops", "n_words"),
        "letters": share("n_letters", "n_chars"),
        "word_length": F.least(share("word_chars", "n_words"), F.lit(30.0)) / 10,
        "short": F.exp(-F.col("n_words") / 30),
        "words": F.log1p("n_words") / 10,
        "breaks": root("n_lines", "n_words"),
    }


@dataclass
class Ranker:
    """score(x) = weights . (x - middle) / spread; good means at least ``threshold``."""

    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float

    def score(self, names: list[str]) -> Column:
        score = F.lit(0.0)
        for name, m, s, w in zip(names, self.middle.tolist(), self.spread.tolist(), self.weights.tolist(), strict=True):
            score = score + (F.col(name) - m) / s * w
        return score

    def column(self, names: list[str]) -> Column:
        """The chance of being good, at least 0.5 exactly from the threshold on."""
        return 1 / (1 + F.exp(-(self.score(names) - self.threshold)))


def slopes(better: np.ndarray, worse: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Slope and curvature of the log-likelihood of all preferences of a good row over a bad one: number of preferences, slope, and the curvature row by row."""
    d = len(weights)
    slope, curve = np.zeros(d), np.zeros((d, d))
    low = worse @ weights
    for at in range(0, len(better), ROWS):
        some = better[at : at + ROWS]
        p = 1 / (1 + np.exp(-np.clip((some @ weights)[:, None] - low, -30, 30)))
        lost = 1 - p
        slope += some.T @ lost.sum(1) - worse.T @ lost.sum(0)
        p *= lost
        mixed = some.T @ p @ worse
        curve += (some.T * p.sum(1)) @ some + (worse.T * p.sum(0)) @ worse - mixed - mixed.T
    return np.concatenate([[len(better) * len(worse)], slope, curve.ravel()])


def _block(columns: list[str]):
    """A block's rows of both kinds, each in one value, in an order of their own."""

    def run(table: pa.Table) -> pa.Table:
        x = np.column_stack([table.column(c).to_numpy() for c in columns])
        good = table.column("good").to_numpy().astype(bool)
        order = np.lexsort(x.T[::-1])
        x, good = x[order], good[order]
        return pa.table({"block": table.column("block")[:1], "better": pa.array([x[good].tobytes()], pa.binary()), "worse": pa.array([x[~good].tobytes()], pa.binary())})

    return run


def summed(blocks: DataFrame, d: int, f: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks, always in one order, of what ``f`` says of a block's good and bad rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, better, worse in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = f(*(np.frombuffer(v, float).reshape(-1, d) for v in (better, worse)))
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "found": pa.array([found.tolist()], pa.list_(pa.float64()))})

    rows = blocks.mapInArrow(run, "block long, found array<double>").collect()
    return np.sum([r["found"] for r in sorted(rows, key=lambda r: r["block"])], axis=0)


def fit(chosen: DataFrame, columns: list[str], ridge: float = 1e-3) -> Ranker:
    """Learn from all rows of ``chosen`` (``row``, by which they are dealt, ``good`` and the columns); without both kinds every score is 0.5.

    Rows are dealt to blocks, of some ``BLOCK`` rows of the commoner kind, and a good row is preferred to each bad one of its block; so the work grows with the
    rows.  The rarer kind stands in as many blocks as it takes for each to have about ``LEAST`` of it, or all.
    """
    d = len(columns)
    n = {r["good"]: r["count"] for r in chosen.groupBy("good").count().collect()}
    if len(n) < 2:
        return Ranker(np.zeros(d), np.ones(d), np.zeros(d), 0.0)
    parts = -(-max(n.values()) // BLOCK)
    better, worse = (min(parts, -(-parts * LEAST // n[kind])) for kind in (True, False))  # blocks that a row stands in
    turns = F.explode(F.sequence(F.lit(0), F.when(F.col("good"), better).otherwise(worse) - 1))
    dealt = chosen.withColumn("turn", turns).withColumn("block", F.pmod(F.pmod("row", F.lit(parts)) + F.col("turn"), F.lit(parts)).cast("long"))
    blocks = stored(dealt.select("block", "good", *columns).groupBy("block").applyInArrow(_block(columns), "block long, better binary, worse binary"))
    middle = summed(blocks, d, lambda x, y: x.sum(0) / better + y.sum(0) / worse) / sum(n.values())
    spread = np.sqrt(summed(blocks, d, lambda x, y: ((x - middle) ** 2).sum(0) / better + ((y - middle) ** 2).sum(0) / worse) / sum(n.values()))
    spread, weights = np.maximum(spread, 1e-6), np.zeros(d)
    for _ in range(50):  # Newton steps on the logistic loss of the differences
        found = summed(blocks, d, lambda x, y, w=weights: slopes((x - middle) / spread, (y - middle) / spread, w))
        slope, curve = found[1 : d + 1] / found[0] - ridge * weights, found[d + 1 :].reshape(d, d) / found[0] + ridge * np.eye(d)
        move = np.linalg.solve(curve, slope)
        weights = weights + move
        if np.abs(move).max() < 1e-8:
            break
    ranker = Ranker(middle, spread, weights, 0.0)
    return replace(ranker, threshold=quantile_threshold(chosen.select(ranker.score(columns).alias("score"), "good", "row"), n))


def quantiles(scores: DataFrame, rows: int, levels: int = 1001) -> np.ndarray:
    """The distinct ones of so many quantiles of ``score``, from the smallest to the largest, between two scores in proportion; equal scores are dealt by ``row``."""
    ordered = stored(scores.orderBy("score", "row").select("score").withColumn("id", F.monotonically_increasing_id()))  # number of the partition and place in it
    sizes = {r["part"]: r["count"] for r in ordered.groupBy(F.shiftright("id", 33).alias("part")).count().collect()}
    parts = np.array(sorted(sizes), np.int64)
    first = np.cumsum([0, *(sizes[p] for p in parts.tolist())])
    place = np.linspace(0, 1, levels) * (rows - 1)
    low = np.floor(place).astype(np.int64)
    ranks = np.unique([low, np.minimum(low + 1, rows - 1)])
    part = np.searchsorted(first, ranks, "right") - 1
    ids = (parts[part] << 33) + ranks - first[part]
    found = {r["id"]: r["score"] for r in ordered.where(F.col("id").isin(ids.tolist())).collect()}
    value = np.array([found[i] for i in ids.tolist()])
    a, b = (value[np.searchsorted(ranks, r)] for r in (low, np.minimum(low + 1, rows - 1)))
    return np.unique(a + (b - a) * (place - low))


def quantile_threshold(scores: DataFrame, n: dict[bool, int]) -> float:
    """The score quantile that parts good from bad best, both kinds, of ``n`` rows, counting alike; the middle one of equals."""
    levels = quantiles(scores, sum(n.values()))
    cut = (levels[1:] + levels[:-1]) / 2 if len(levels) > 1 else levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above = np.searchsorted(cut, batch.column(0).to_numpy(), "right")  # cuts that the score reaches
            yield pa.RecordBatch.from_arrays([pa.array(above), batch.column(1)], names=["above", "good"])

    counts = {kind: np.zeros(len(cut) + 1) for kind in n}
    for r in scores.select("score", "good").mapInArrow(run, "above long, good boolean").groupBy("above", "good").count().collect():
        counts[r["good"]][r["above"]] = r["count"]
    below = {kind: np.cumsum(c)[:-1] / n[kind] for kind, c in counts.items()}  # share of rows below each cut
    kept = 1 - below[True] + below[False]
    best = np.flatnonzero(kept >= kept.max() - 1e-12)
    return float(cut[best[len(best) // 2]])


def held_out(key: str, folds: int = 3, fold: int = 1) -> Column:
    """True for keys whose crc32, as text, leaves ``fold``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds == fold


def quality_scores(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """Every document with ``held_out``, ``score`` (0 to 1) and ``predicted``.

    All labelled documents outside the held-out fold take part in the fit, and all documents are scored.  A null text is empty.  Labels that are null or without a document are ignored, rows
    repeating a key are scored each on its own; without labels of both kinds all scores are 0.5.
    """
    columns = features()
    measured = stored(text_measures(docs, key, text).select(key, *[c.cast("double").alias(n) for n, c in columns.items()]))
    score = fitted(measured, labels, key, label).column(list(columns))
    return measured.select(key, held_out(key).alias("held_out"), score.alias("score"), F.when(score >= 0.5, 1).otherwise(0).alias("predicted"))


def fitted(measured: DataFrame, labels: DataFrame, key: str, label: str) -> Ranker:
    """The ranker learned from all rows of ``measured`` that have a label and aren't held out."""
    columns = list(features())
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key)).select(key, (F.col(label) == 1).alias("good")).distinct()
    return fit(stored(measured.join(known, key).select(F.xxhash64(key).alias("row"), "good", *columns)), columns)


def good_documents(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """The rows that are predicted to be good, with all their columns: those of ``quality_scores`` with ``predicted`` 1.

    Each row is judged by its own text, where it lies, so ids may repeat or be null, and no text is shuffled.
    """
    columns = features()
    measured = text_measures(docs, key, text).select(key, *[c.cast("double").alias(n) for n, c in columns.items()])
    ranker = fitted(measured, labels, key, label)
    apart = docs.toDF(*[f"own_{i}" for i in range(len(docs.columns))])  # names of its own
    figures = with_measures(apart, f"own_{docs.columns.index(text)}")
    score = figures.select("*", *[c.cast("double").alias(n) for n, c in columns.items()]).where(ranker.column(list(columns)) >= 0.5)
    return score.select(*apart.columns).toDF(*docs.columns)
