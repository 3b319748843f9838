"""Session factory for scripts; what is set already, by submit or by the running session, stays."""

from __future__ import annotations

from pyspark import SparkConf
from pyspark.sql import SparkSession


def get_session(app: str = "opinara", master: str | None = None, **conf: str) -> SparkSession:
    """Return the running session or build one.

    Shuffle width is left to adaptive execution (it coalesces small partitions
    and splits skewed ones); pass ``spark.sql.shuffle.partitions`` through
    ``conf`` to raise the starting point for very large inputs.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    known = SparkConf()
    for key, value in settings.items():
        if key in conf or not known.contains(key):
            builder = builder.config(key, value)
    return builder.getOrCreate()
