"""Review analytics on Spark: DataFrame in, DataFrame out.

Every operator reads a *review table*: one row per review, with the column
roles of :mod:`opinara.roles`.  Nothing here collects rows to the driver except
model summaries whose size a parameter bounds (topics, clusters, vocabulary).
"""

__version__ = "0.1.0"
