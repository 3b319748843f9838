"""Exact top-k search by distributed histogram selection.

Every query is scored against every candidate.  Counts of scores in ever finer bins, summed over all tasks, close in
on each query's k-th highest score; then the scores at or above it are kept and ties go to smaller ids.
Queries are taken in blocks of a fixed size, so that a block can be sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opinara.llm.durable import stored

ROWS = 2048  # candidates scored at once


def usable(vector: str, key: str) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.col(key).isNotNull() & F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))


def quantised(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """Rows that take part: id and integer components floor(scale * x)."""
    return vectors.where(usable(vector, key)).select(F.col(key).cast("long").alias("id"), F.transform(vector, lambda x: F.floor(scale * x.cast("double"))).alias("v"))


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids in rising order and their vectors, apart for each dimension, some rows at a time."""
    ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        rows = rows[np.argsort(ids[rows], kind="stable")]
        for part in np.array_split(rows, max(1, -(-len(rows) // ROWS))):
            yield ids[part], flat[starts[part][:, None] + np.arange(d)]


class Block:
    """Queries of one block, by dimension, with what is known of their k-th score."""

    def __init__(self, rows: list, k: int, reach: int) -> None:
        self.ids = np.array([r["id"] for r in rows], np.int64)
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        sizes = np.array([len(r["v"]) for r in rows])
        for d in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == d)
            self.by_size[d] = (at, np.array([rows[i]["v"] for i in at], np.int64).reshape(len(at), d))
        self.low = np.full(len(rows), -reach, np.int64)
        self.high = np.full(len(rows), reach, np.int64)
        self.need = np.full(len(rows), k, np.int64)
        self.exact = reach < 1 << 53

    def scores(self, ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query numbers, their scores against the vectors, and which pairs count."""
        at, own = self.by_size.get(vectors.shape[1], (np.zeros(0, np.int64), np.zeros((0, vectors.shape[1]), np.int64)))
        if self.exact:  # whole numbers below 2**53 are exact in floating point
            found = (own.astype(float) @ vectors.astype(float).T).astype(np.int64)
        else:
            found = own @ vectors.T
        return at, found, self.ids[at][:, None] != ids[None, :]


def _count(block: Block, k: int, bins: int):
    width = -(-(block.high - block.low + 1) // bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, vectors in _blocks(batch):
                at, found, other = block.scores(ids, vectors)
                if not len(at) or not len(ids):
                    continue
                low = block.low[at]
                if len(ids) > k:  # bins below this block's own k-th score can't hold the k-th of all
                    own = np.where(other, found, np.iinfo(np.int64).min)
                    low = np.maximum(low, np.partition(own, len(ids) - k, axis=1)[:, len(ids) - k])
                    low = block.low[at] + (low - block.low[at]) // width[at] * width[at]
                q, c = np.nonzero(other & (found >= low[:, None]) & (found <= block.high[at][:, None]))
                code, n = np.unique(np.stack([at[q], (found[q, c] - block.low[at[q]]) // width[at[q]]]), axis=1, return_counts=True)
                if len(n):
                    yield pa.RecordBatch.from_pydict({"q": code[0], "bin": code[1], "need": block.need[code[0]], "n": n})

    return run, width


def _select(block: Block, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, vectors in _blocks(batch):
                at, found, other = block.scores(ids, vectors)
                least = block.low[at][:, None]
                tie = other & (found == least)
                tie &= np.cumsum(tie, axis=1) <= k  # ids rise: later ties of this block come after k better ones
                q, c = np.nonzero(other & (found > least) | tie)
                if len(q):
                    yield pa.RecordBatch.from_pydict({"q": at[q], "query_id": block.ids[at[q]], "vec_id": ids[c], "score": found[q, c]})

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256, bins: int = 1024, block: int = 4096) -> DataFrame:
    """The ``k`` highest inner products of every query row with the rows of other ids.

    Returns query_id, rank, vec_id, score.  Rows with a null id, a null vector or a null or non-finite component take no part;
    vectors are compared with those of their own length.  Query rows that repeat an id are answered each;
    candidates that repeat an id count each.  Fewer than k candidates: all of them.
    """
    spark = vectors.sparkSession
    data, asked = quantised(vectors, key, vector, scale), quantised(queries, key, vector, scale).distinct()
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    squares = data.unionByName(asked).select(square.alias("s"))
    reach = int(squares.agg(F.max("s")).first()[0] or 0) + 1  # no score is larger
    reach = min(reach, (1 << 62) - 1)
    numbered = asked.withColumn("h", F.xxhash64("v"))
    parts, after = [], None
    while True:
        rest = numbered if after is None else numbered.where((F.col("id") > after[0]) | ((F.col("id") == after[0]) & (F.col("h") > after[1])))
        rows = rest.orderBy("id", "h").limit(block).collect()  # at most one block
        if not rows:
            break
        after = (rows[-1]["id"], rows[-1]["h"])
        parts.append(_answer(data, Block(rows, k, reach), k, bins))
        if len(rows) < block:
            break
    empty = "query_id long, rank int, vec_id long, score long"
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], empty)


def _answer(data: DataFrame, block: Block, k: int, bins: int) -> DataFrame:
    while (block.high > block.low).any():
        run, width = _count(block, k, bins)
        counts = data.mapInArrow(run, "q long, bin long, need long, n long").groupBy("q", "bin", "need").agg(F.sum("n").alias("n"))
        above = F.coalesce(F.sum("n").over(W.partitionBy("q").orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        found = counts.withColumn("above", above).where((F.col("above") < F.col("need")) & (F.col("above") + F.col("n") >= F.col("need")))
        hit = np.array([(r["q"], r["bin"], r["above"]) for r in found.collect()], np.int64).reshape(-1, 3)  # a row for each query of the block
        q = hit[:, 0]
        few = np.setdiff1d(np.arange(len(block.ids)), q)  # fewer than k candidates: everything counts
        block.high[few] = block.low[few]
        block.low[q] += hit[:, 1] * width[q]
        block.high[q] = np.minimum(block.low[q] + width[q] - 1, block.high[q])
        block.need[q] -= hit[:, 2]
    order = W.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return stored(
        data.mapInArrow(_select(block, k), "q long, query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
