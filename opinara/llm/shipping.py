"""Giving executors this package, which they don't have installed."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors as a zip, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/opinara", "zip", root, "opinara"))
    _shipped.add(context.applicationId)
