"""Cutting lineage through the folder all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ready(spark: SparkSession) -> None:
    """Use the folder of ``spark.checkpoint.dir``.

    Where it is unset, a session on one machine, as in tests, gets a folder of its own; on a cluster, whose executors don't share one, that is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        folder = tempfile.mkdtemp(prefix="checkpoints-")
    if folder is None:
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    context.setCheckpointDir(folder)


#: Spark's setting that shuffle files go as soon as the query that made them has ended, not when the driver's memory is next tidied up.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Queries made here leave no shuffle files: for tables that are written whole, which nothing reads their shuffles for again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def stored(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and kept in the shared folder, without the shuffles that led to them."""
    ready(df.sparkSession)
    with shuffles_go(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a query of its own, made under the setting


def written(df: DataFrame) -> DataFrame:
    """As ``stored``, as a table in the shared folder: Spark knows its size, and sends it to all tasks where that is small."""
    ready(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    with shuffles_go(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Total bytes of the texts."""
    return docs.select(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
