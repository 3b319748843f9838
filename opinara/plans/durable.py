"""Keep the input of an iterative fit, in a layout that depends on its rows alone, for as long as a result lives."""

from __future__ import annotations

import math
import uuid
from types import TracebackType
from typing import Self

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partitions_for(rows: int) -> int:
    """Partitions for so many rows.

    Their number and their size both grow as the root: 8 for ten thousand rows, 250 for nine million, 14,000 for thirty billion.
    """
    return max(1, round(math.sqrt(rows) / 12))


def shared_folder(df: DataFrame) -> str | None:
    """The checkpoint folder, the caller's own or that of ``spark.checkpoint.dir``; None where there is none."""
    context = df.sparkSession.sparkContext
    shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None and shared:
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def kept(df: DataFrame) -> DataFrame:
    """The rows of ``df`` as they are dealt: written to the checkpoint folder, where a lost executor costs no recomputation, or persisted until ``release``."""
    return df.checkpoint(eager=True) if shared_folder(df) is not None else df.persist(StorageLevel.MEMORY_AND_DISK)


def durable(df: DataFrame, *keys: str) -> DataFrame:
    """The same rows, dealt by their keys and ordered inside, so that a fit that reads rows in order gives the same model whatever the input's layout.

    The rows are kept once as they come, which counts them, and once more as dealt; their number gives that of the partitions
    (``partitions_for``).  Keys should name a row, not only its text, so that copies of one text spread.
    """
    first = kept(df)
    laid = kept(first.repartition(partitions_for(first.count()), *keys).sortWithinPartitions(*keys))
    laid.count()  # from the first copy, which goes
    release(first)
    return laid


def in_batches(df: DataFrame, batch: str, batches: int, key: Column) -> tuple[DataFrame, int]:
    """The same rows kept so that those of one ``batch`` (a number below ``batches``) are read without the others, and how many there are.

    Each batch is dealt by ``key`` to as many tasks as its share of the rows asks for.
    """
    first = kept(df)
    rows = first.count()
    slices = partitions_for(rows // batches)
    laid = first.repartition(batches * slices, batch, F.pmod(F.xxhash64(F.lit("slice"), key), F.lit(slices)))
    folder = shared_folder(df)
    if folder is None:
        laid = laid.persist(StorageLevel.MEMORY_AND_DISK)
        laid.count()
    else:
        path = f"{folder}/batches-{uuid.uuid4().hex}"
        laid.write.partitionBy(batch).parquet(path)
        laid = df.sparkSession.read.schema(laid.schema).parquet(path)
    release(first)
    return laid, rows


def release(df: DataFrame) -> None:
    """Give up what was persisted; nothing happens to a checkpoint."""
    df.unpersist(blocking=True)


class Lasting:
    """A result that holds tables (``held``) until it is closed; usable in a ``with`` statement.

    Frames of a closed result can still be read, and are then computed anew.
    """

    held: tuple[DataFrame, ...] = ()

    def close(self) -> None:
        for df in self.held:
            release(df)

    def __enter__(self) -> Self:
        return self

    def __exit__(self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None) -> None:
        self.close()
