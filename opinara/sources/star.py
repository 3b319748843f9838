"""Review tables derived from the star-schema test tables.

A review is one line item; its entity is the supplier, its segment the nation of
the customer, its text the part name followed by a whole document.  All columns
are SQL expressions over the joined tables, so the SQL checks can use the same
definitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Column of the review table -> (expression, tables it needs besides lineitem).
REVIEW_COLUMNS: dict[str, tuple[str, tuple[str, ...]]] = {
    "entity": ("s_name", ("supplier",)),
    "event_date": ("cast(o_orderdate as date)", ("orders",)),
    "lat": ("cast(s_nationkey as double) * 2.5e0 - 30e0", ("supplier",)),
    "lng": (
        "cast(sn_regionkey as double) * 20e0 + cast(s_suppkey % 10 as double)",
        ("supplier", "supplier_nation"),
    ),
    "prior_score": ("7e0 + cast(s_suppkey % 24 as double) / 8e0", ("supplier",)),
    "total_reviews": ("cast(100 + s_suppkey % 900 as int)", ("supplier",)),
    "score": (
        "case when s_suppkey % 3 = 0 then 6e0 + cast(cast(l_quantity as int) % 9 as double) / 2e0"
        " else 2.5e0 + cast(cast(l_quantity as int) % 16 as double) / 2e0 end",
        ("supplier",),
    ),
    "segment": ("concat(' ', cn_name, ' ')", ("orders", "customer", "customer_nation")),
    "neg_text": (
        "case when (l_orderkey + l_linenumber) % 5 = 0 then 'No Negative'"
        " else concat(p_name, ' ', doc_text) end",
        ("part", "documents"),
    ),
    "pos_text": (
        "case when (l_orderkey + l_linenumber) % 7 = 0 then 'No Positive'"
        " else concat(doc_text, ' ', p_type) end",
        ("part", "documents"),
    ),
    "tags": (
        "case l_orderkey % 6 when 0 then 'Leisure trip, Couple, Double Room'"
        " when 1 then 'Leisure trip, Family with young children'"
        " when 2 then 'Business trip, Solo traveler' when 3 then 'Leisure trip, Group'"
        " when 4 then 'Couple, Family Room' else 'Travelers with friends' end",
        (),
    ),
}
#: Columns read off the review table itself, in a second step so that each text is built once.
WORD_COLUMNS: dict[str, tuple[str, str]] = {
    "neg_words": (
        "case when neg_text = 'No Negative' then 0"
        " else octet_length(neg_text) - octet_length(replace(neg_text, ' ', '')) + 1 end",
        "neg_text",
    ),
    "pos_words": (
        "case when pos_text = 'No Positive' then 0"
        " else octet_length(pos_text) - octet_length(replace(pos_text, ' ', '')) + 1 end",
        "pos_text",
    ),
}
ALL_COLUMNS = (*REVIEW_COLUMNS, *WORD_COLUMNS)

#: The same table as untyped text with holes, for the cleaning operators.
RAW_COLUMNS: dict[str, str] = {
    "entity": "case when l_orderkey % 97 = 0 then '' else entity end",
    "event_date": "case when (l_orderkey + l_linenumber) % 89 = 0 then null else cast(event_date as varchar(10)) end",
    "neg_text": "case when l_orderkey % 83 = 0 then 'NA' else neg_text end",
    "pos_text": "case when (l_orderkey + l_linenumber) % 79 = 0 then null else pos_text end",
    "lat": "case l_orderkey % 73 when 0 then 'NA' when 1 then 'n/a' when 2 then ' NA'"
    " else cast(lat as varchar(20)) end",
    "lng": "case l_orderkey % 71 when 0 then '' when 1 then 'NaN' else cast(lng as varchar(20)) end",
    "prior_score": "case when l_orderkey % 67 = 0 then 'unknown' else cast(prior_score as varchar(20)) end",
    "total_reviews": "case when l_orderkey % 61 = 0 then 'many' else cast(total_reviews as varchar(20)) end",
    "score": "case l_orderkey % 59 when 0 then 'NA' when 1 then 'NaN' when 2 then 'Infinity' else cast(score as varchar(20)) end",
    "segment": "case when l_orderkey % 53 = 0 then 'NA' else segment end",
    "tags": "tags",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _joined(spark: SparkSession, sf_dir: str, needs: set[str], lines: DataFrame | None = None) -> DataFrame:
    """Line items, or the given ones of them, with the dimensions asked for.

    Every dimension is looked up by its key with an outer join, so the rows of
    the result do not depend on which dimensions take part.  No hint is given:
    Spark broadcasts a dimension only when its size allows and adaptive execution
    splits a skewed key otherwise.
    """
    rows = table(spark, sf_dir, "lineitem") if lines is None else lines
    if "orders" in needs:
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if "customer" in needs:
        customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        rows = rows.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    if "customer_nation" in needs:
        nation = table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("cn_name")
        )
        rows = rows.join(nation, F.col("c_nationkey") == F.col("cn_key"), "left")
    if "supplier" in needs:
        supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
        rows = rows.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    if "supplier_nation" in needs:
        nation = table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("sn_key"), F.col("n_regionkey").alias("sn_regionkey")
        )
        rows = rows.join(nation, F.col("s_nationkey") == F.col("sn_key"), "left")
    if "part" in needs:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
        rows = rows.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    if "documents" in needs:
        documents = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("doc_text"))
        n_documents = documents.agg(F.count(F.lit(1))).scalar()
        keyed = rows.withColumn("doc_key", F.expr("l_orderkey * 8 + l_linenumber") % n_documents)
        # This join widens a row from tens of bytes to kilobytes, so the still narrow rows are
        # spread by its key first: the one exchange serves a sort-merge join as well.
        rows = keyed.repartition("doc_key").join(documents, F.col("doc_key") == F.col("doc_id"), "left")
    return rows


def reviews(
    spark: SparkSession,
    sf_dir: str,
    columns: Sequence[str] = ALL_COLUMNS,
    keep: Sequence[str] = (),
    lines: DataFrame | None = None,
) -> DataFrame:
    """The review table, or that of given line items, joining only what the asked-for columns need."""
    counted = [name for name in columns if name in WORD_COLUMNS]
    base = [name for name in columns if name in REVIEW_COLUMNS]
    base += [WORD_COLUMNS[name][1] for name in counted if WORD_COLUMNS[name][1] not in base]
    needs = {need for name in base for need in REVIEW_COLUMNS[name][1]}
    rows = _joined(spark, sf_dir, needs, lines).select(
        *keep, *(F.expr(REVIEW_COLUMNS[name][0]).alias(name) for name in base)
    )
    words = {name: F.expr(WORD_COLUMNS[name][0]) for name in counted}
    return rows.withColumns(words).select(*keep, *columns) if words else rows


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review table as it might arrive: text columns, NA tokens, junk, holes."""
    rows = reviews(spark, sf_dir, tuple(REVIEW_COLUMNS), keep=("l_orderkey", "l_linenumber"))
    return rows.select(*(F.expr(sql).alias(name) for name, sql in RAW_COLUMNS.items()))


def document_reviews(spark: SparkSession, sf_dir: str, labelled: bool = False) -> DataFrame:
    """One review per document: its whole text, its source as entity, its language as segment.

    ``labelled`` keeps the documents with a quality label and scores them 10 or 5,
    so that text and score carry a common signal.
    """
    documents = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("source").alias("entity"),
        F.col("lang").alias("segment"),
        F.col("text").alias("neg_text"),
    )
    if not labelled:
        return documents
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    scored = F.when(F.col("quality") == 1, 10.0).otherwise(5.0)
    return documents.join(labels, "doc_id").select(
        "doc_id", "entity", "segment", "neg_text", F.lit(None).cast("string").alias("pos_text"),
        scored.alias("score"),
    )
