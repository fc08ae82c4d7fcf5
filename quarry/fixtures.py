"""Stand-in inputs built from the test tables.

These only give rows in the schema each job expects; the jobs never rely on
how the rows were made. Every mapping keeps whole tables and whole texts.

* corpus A: every line of every ``documents.text``
* corpus B: every line of every ``conversations.text``
* ratings: every line item as ``(customer of its order, part key mod 500,
  quantity)`` — 500 items as in the reference's catalogue, duplicates kept
* postings: every order as a question (tag = order priority) and every line
  item as an answer to its order (score = floor of the extended price)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.tables import read_parquet
from quarry.sources.text import lines_of

# The stop-word list used with the test corpora, and the domain
# list (order priorities, positions 0..4) used with the test postings.
STOPWORDS = ["The", "of", "and", "to", "in"]
PRIORITY_DOMAINS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
N_ITEMS = 500
TARGET_USER = 21
# Columns by which a line item is later than another.
RATING_ORDER = ["l_orderkey", "l_linenumber", "l_partkey"]


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan of one test table (only ``columns``), spread if under-split."""
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", columns)


def corpus_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines (``doc_id, value``) of all documents."""
    return lines_of(table(spark, sf_dir, "documents", "doc_id", "text"), "text", keep=("doc_id",))


def corpus_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines (``doc_id, value``) of all conversation turns; doc_id = conv_id*1000+turn."""
    conv = table(spark, sf_dir, "conversations", "conv_id", "turn", "text").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text")
    return lines_of(conv, "text", keep=("doc_id",))


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_id, item_id, pref`` (bigint), one row per line item, duplicates kept."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("bigint").alias("user_id"),
        (F.col("l_partkey") % N_ITEMS).cast("bigint").alias("item_id"),
        F.col("l_quantity").cast("bigint").alias("pref"),
    )


def ordered_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_ratings`` with the columns that order the line items, ``RATING_ORDER``."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_linenumber")
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("bigint").alias("user_id"), (F.col("l_partkey") % N_ITEMS).cast("bigint").alias("item_id"),
        F.col("l_quantity").cast("bigint").alias("pref"), *RATING_ORDER)


def wide_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per line item over every part key; by line number a quarter of the prefs is 0, a quarter negative."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_linenumber")
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    kind, pref = F.col("l_linenumber") % 4, F.col("l_quantity").cast("bigint")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("bigint").alias("user_id"), F.col("l_partkey").cast("bigint").alias("item_id"),
        F.when(kind == 0, F.lit(0).cast("bigint")).when(kind == 1, -pref).otherwise(pref).alias("pref"))


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``posting_type, id, parent_id, score, tag`` (questions then answers)."""
    q = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority").select(
        F.lit(1).cast("int").alias("posting_type"),
        F.col("o_orderkey").cast("bigint").alias("id"),
        F.lit(None).cast("bigint").alias("parent_id"),
        F.lit(0).cast("bigint").alias("score"),
        F.col("o_orderpriority").alias("tag"),
    )
    a = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice").select(
        F.lit(2).cast("int").alias("posting_type"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("id"),
        F.col("l_orderkey").cast("bigint").alias("parent_id"),
        F.floor("l_extendedprice").cast("bigint").alias("score"),
        F.lit(None).cast("string").alias("tag"),
    )
    return q.unionByName(a)
