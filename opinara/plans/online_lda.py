"""Latent topics by online variational inference over keyed mini-batches.

A text belongs to the mini-batch that its key's hash names, so an epoch meets every text exactly once, and which texts meet
doesn't depend on how rows are dealt.  Tasks infer the topics of their texts and send expected word counts; the driver
holds one number for each topic and word.  Counts travel as whole multiples of a small unit, whose sum is the same in any
order: a fit gives the same model on every cluster.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.linalg import DenseMatrix
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts inferred at once, most rounds and the mean change that ends them, for each text alone.
ROWS, ROUNDS, SETTLED = 512, 100, 1e-3
UNIT = 2.0**16

# tasks get these functions by value: executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _lgamma(x: np.ndarray) -> np.ndarray:
    return np.vectorize(math.lgamma, otypes=[float])(x)


def digamma(x: np.ndarray) -> np.ndarray:
    """Derivative of the log gamma function, for positive numbers."""
    x = np.array(x, float)
    shift = np.zeros_like(x)
    for _ in range(6):
        low = x < 6
        shift[low] -= 1 / x[low]
        x[low] += 1
    square = 1 / (x * x)
    return shift + np.log(x) - 0.5 / x - square * (1 / 12 - square * (1 / 120 - square * (1 / 252 - square * (1 / 240 - square / 132))))


def _log_shares(counts: np.ndarray) -> np.ndarray:
    """Expected logarithm of shares drawn with these counts, along the last axis."""
    return digamma(counts) - digamma(counts.sum(-1, keepdims=True))


@dataclass
class Texts:
    """Word counts of some texts: entries ``word``, ``n`` of text ``row``."""

    rows: int
    row: np.ndarray
    word: np.ndarray
    n: np.ndarray

    def per_row(self, entries: np.ndarray) -> np.ndarray:
        """Sums over each text's entries, for each topic."""
        return np.stack([np.bincount(self.row, e, self.rows) for e in entries], 1)


def _texts(column: pa.StructArray) -> Iterator[Texts]:
    """The sparse vectors of a batch, some rows at a time."""
    for first in range(0, len(column), ROWS):
        some = column.slice(first, ROWS)
        words, counts = some.field("indices"), some.field("values")
        row = np.repeat(np.arange(len(some)), words.value_lengths().to_numpy(zero_copy_only=False))
        yield Texts(len(some), row, words.flatten().to_numpy(zero_copy_only=False), counts.flatten().to_numpy(zero_copy_only=False))


def infer(texts: Texts, weight: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Topic counts of each text, and each entry's chances by topic (topics x entries), under ``weight``, the words' weights by topic.

    Every text ends its own rounds, so its result doesn't depend on the texts beside it.
    """
    k = len(weight)
    entry = weight[:, texts.word]
    gamma = np.repeat((alpha + np.bincount(texts.row, texts.n, texts.rows) / k)[:, None], k, 1)
    moving = np.ones(texts.rows, bool)
    for _ in range(ROUNDS):
        mine = moving[texts.row]
        part = Texts(texts.rows, texts.row[mine], texts.word[mine], texts.n[mine])
        share = np.exp(_log_shares(gamma)).T[:, part.row] * entry[:, mine]
        new = alpha + part.per_row(share / (share.sum(0) + 1e-100) * part.n)
        change = np.abs(new - gamma).mean(1)
        gamma[moving] = new[moving]
        moving &= change >= SETTLED
        if not moving.any():
            break
    share = np.exp(_log_shares(gamma)).T[:, texts.row] * entry
    return gamma, share / (share.sum(0) + 1e-100)


@dataclass(frozen=True)
class TopicModel:
    """``counts``: topics x words.  The methods are named as those of ``pyspark.ml`` models."""

    counts: np.ndarray
    alpha: float
    eta: float
    features: str = "features"

    @property
    def k(self) -> int:
        return len(self.counts)

    def topicsMatrix(self) -> DenseMatrix:
        """Words x topics."""
        return DenseMatrix(self.counts.shape[1], self.k, self.counts.ravel().tolist())

    def describeTopics(self, maxTermsPerTopic: int = 10) -> DataFrame:
        """``topic, termIndices, termWeights``; of equal weights the smaller word number comes first."""
        shares = self.counts / self.counts.sum(1, keepdims=True)
        order = np.argsort(-shares, axis=1, kind="stable")[:, :maxTermsPerTopic]
        rows = [(i, o.tolist(), shares[i][o].tolist()) for i, o in enumerate(order)]
        return SparkSession.active().createDataFrame(rows, "topic int, termIndices array<int>, termWeights array<double>")

    def transform(self, vectors: DataFrame) -> DataFrame:
        """Adds ``topicDistribution``, the share of each topic in each text."""
        weight, alpha, at = np.exp(_log_shares(self.counts)), self.alpha, vectors.columns.index(self.features)
        names = [*vectors.columns, "topicDistribution"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [infer(t, weight, alpha)[0] for t in _texts(batch.column(at))]
                shares = [pa.array((g / g.sum(1, keepdims=True)).tolist(), pa.list_(pa.float64())) for g in found]
                added = pa.concat_arrays(shares) if shares else pa.array([], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, added], names=names)

        schema = vectors.withColumn("topicDistribution", F.lit(None).cast("array<double>")).schema
        return vectors.mapInArrow(run, schema)

    def logLikelihood(self, vectors: DataFrame) -> float:
        """Lower bound of the log probability of the texts and topics."""
        log_weight, alpha, k, at = _log_shares(self.counts), self.alpha, self.k, vectors.columns.index(self.features)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for texts in _texts(batch.column(at)):
                    gamma, _ = infer(texts, np.exp(log_weight), alpha)
                    log_share = _log_shares(gamma)
                    entry = log_share.T[:, texts.row] + log_weight[:, texts.word]
                    top = entry.max(0)
                    bound = np.bincount(texts.row, texts.n * (top + np.log(np.exp(entry - top).sum(0))), texts.rows)
                    bound += ((alpha - gamma) * log_share + _lgamma(gamma)).sum(1) - k * math.lgamma(alpha)
                    bound += math.lgamma(k * alpha) - _lgamma(gamma.sum(1))
                    yield pa.RecordBatch.from_pydict({"bound": np.rint(bound * UNIT).astype(np.int64)})

        texts_bound = (vectors.mapInArrow(run, "bound long").agg(F.sum("bound")).first()[0] or 0) / UNIT
        total, size = self.counts.sum(1), self.counts.shape[1]
        topics = ((self.eta - self.counts) * log_weight + _lgamma(self.counts)).sum() - self.counts.size * math.lgamma(self.eta)
        return texts_bound + float(topics + (math.lgamma(size * self.eta) - _lgamma(total)).sum())

    def logPerplexity(self, vectors: DataFrame) -> float:
        """Minus the likelihood's share of each word."""
        at = vectors.columns.index(self.features)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"n": [float(sum(t.n.sum() for t in _texts(batch.column(at))))]})

        words = vectors.mapInArrow(run, "n double").agg(F.sum("n")).first()[0]
        return -self.logLikelihood(vectors) / words


def batch_of(key: Column, batches: int) -> Column:
    """The mini-batch of a row."""
    return F.pmod(F.xxhash64(F.lit("batch"), key), F.lit(batches)).cast("int")


def _expected(batch: DataFrame, features: str, weights: Sequence[np.ndarray], alpha: float) -> tuple[int, list[np.ndarray]]:
    """Number of texts, and for each model the expected word counts by topic."""
    at, k, size = batch.columns.index(features), *weights[0].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts_seen = np.zeros((len(weights), k * size), np.int64), 0
        for rows in batches:
            for texts in _texts(rows.column(at)):
                texts_seen += texts.rows
                for m, weight in enumerate(weights):
                    _, share = infer(texts, weight, alpha)
                    whole = np.rint(share * texts.n * UNIT)
                    for topic in range(k):  # sums of whole numbers below 2**53 are exact
                        total[m, topic * size : (topic + 1) * size] += np.bincount(texts.word, whole[topic], size).astype(np.int64)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": np.append(cells, -1), "n": np.append(total.ravel()[cells], texts_seen)})

    found = batch.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cell, n = found["cell"].to_numpy(), found["n"].to_numpy()
    counts = np.zeros(len(weights) * k * size)
    counts[cell[cell >= 0]] = n[cell >= 0] / UNIT
    return int(n[cell < 0].sum()), list(counts.reshape(len(weights), k, size))


def fit_online(
    vectors: DataFrame, n_words: int, k: int, seeds: Sequence[int], batches: int = 20, epochs: int = 1, offset: float = 1.0, decay: float = 0.7, features: str = "features"
) -> list[TopicModel]:
    """A model for each seed, all learned in the same passes over ``vectors`` (a sparse vector in ``features``, the mini-batch in ``batch``).

    Step t moves the counts by (offset + t) ** -decay towards those expected from its batch alone.  Empty batches are no steps.
    """
    alpha = eta = 1 / k
    counts = [np.random.default_rng(seed).gamma(100.0, 0.01, (k, n_words)) for seed in seeds]
    sizes = {r["batch"]: r["n"] for r in vectors.groupBy("batch").agg(F.count("*").alias("n")).collect()}
    n_texts, step = sum(sizes.values()), 0
    for _ in range(epochs):
        for number in sorted(sizes):
            weights = [np.exp(_log_shares(c)) for c in counts]
            n, expected = _expected(vectors.filter(F.col("batch") == number), features, weights, alpha)
            rate = (offset + step + 1) ** -decay
            counts = [(1 - rate) * c + rate * (eta + n_texts / n * e) for c, e in zip(counts, expected, strict=True)]
            step += 1
    return [TopicModel(c, alpha, eta, features) for c in counts]
