"""Input tables of the registered queries, built from the given tables, and their SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import FEWEST_PARTITIONS, dealt, partitions_for
from millrace.sources import table

# Stand-in for an "unknown" marker in the given tables.
SENTINEL = "4-NOT SPECIFIED"

CLASS_NAMES = [
    "A: amber",
    "B: beryl",
    "C: coral",
    "D: dark opal",
    "E: emerald",
    "F: fire agate",
    "G: garnet",
    "H: heliodor",
    "I: iolite",
    "J: jasper",
]
QUESTION = "Which class does the picture show?"


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").drop("o_orderdate")


def marked_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in which a priority and a status stand for "unknown"."""
    return orders(spark, sf).replace("P", "4-NOT SPECIFIED", subset=["o_orderstatus"])


MARKED_ORDERS_SQL = """
marked AS (
  SELECT o_orderkey, o_custkey, replace(o_orderstatus, 'P', '4-NOT SPECIFIED') AS o_orderstatus,
         o_totalprice, o_orderpriority
  FROM orders)"""

CLEAN_ORDERS_SQL = (
    MARKED_ORDERS_SQL
    + """,
cleaned AS (
  SELECT o_orderkey, o_custkey, nullif(o_orderstatus, '4-NOT SPECIFIED') AS o_orderstatus,
         o_totalprice, nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority
  FROM marked)"""
)


def scored_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with a score that carries some signal about the 0/1 label."""
    score = F.col("l_quantity") * (1 - F.col("l_discount"))
    label = ((F.col("l_quantity") + 100 * F.col("l_tax") * F.col("l_discount")) > 25).cast("int")
    return table(spark, sf, "lineitem").select(score.alias("score"), label.alias("label"))


SCORED_LINES_SQL = """
p AS (
  SELECT l_quantity * (1 - l_discount) AS score,
         ((l_quantity + 100 * l_tax * l_discount) > 25)::INT AS label
  FROM lineitem)"""


def scored_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with their length as score."""
    labels = table(spark, sf, "labels")
    documents = table(spark, sf, "documents").select("doc_id", "n_chars")
    joined = documents.join(labels, "doc_id")
    return joined.select(F.col("n_chars").cast("double").alias("score"), F.col("quality").alias("label"))


SCORED_DOCUMENTS_SQL = """
p AS (
  SELECT n_chars::DOUBLE AS score, quality AS label
  FROM documents JOIN labels USING (doc_id))"""


def ruled_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Order status against a rule on the price; one rule outcome is no real status."""
    price = F.col("o_totalprice")
    rule = F.when(price >= 400000, "X").when(price >= 250000, "F").when(price >= 100000, "O").otherwise("P")
    return table(spark, sf, "orders").select(F.col("o_orderstatus").alias("label"), rule.alias("prediction"))


RULED_ORDERS_SQL = """
p AS (
  SELECT o_orderstatus AS label,
         CASE WHEN o_totalprice >= 400000 THEN 'X' WHEN o_totalprice >= 250000 THEN 'F'
              WHEN o_totalprice >= 100000 THEN 'O' ELSE 'P' END AS prediction
  FROM orders)"""


def order_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Training rows in the shape of a census table: text categories, numbers, a noisy label.

    The label follows price and balance; one row in ten, chosen by hash, has it turned around. A small table
    is dealt out before the join, which sends it the customers; a large one behind it, as the join may shuffle it.
    """
    rows = table(spark, sf, "orders")
    partitions = partitions_for(rows)
    if partitions > FEWEST_PARTITIONS:
        return dealt(joined_orders(spark, sf, rows), ["o_orderkey"], partitions)
    return joined_orders(spark, sf, dealt(rows, ["o_orderkey"], partitions))


def joined_orders(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    """The training rows of orders, by default of the table as it lies."""
    rows = table(spark, sf, "orders") if rows is None else rows
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    joined = rows.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    clean = F.col("o_totalprice") + 20 * F.col("c_acctbal") > 340000
    noise = F.conv(F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 4), 16, 10).cast("int") % 10 == 0
    return joined.select(
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        "c_mktsegment",
        F.col("c_nationkey").cast("string").alias("nation"),
        "o_totalprice",
        "c_acctbal",
        (clean != noise).cast("double").alias("label"),
    )


ORDER_CATEGORIES = ["o_orderstatus", "o_orderpriority", "c_mktsegment", "nation"]
ORDER_NUMBERS = ["o_totalprice", "c_acctbal"]

GROUP_COLUMNS = ["o_orderstatus", "o_orderpriority"]


def grouped_orders(spark: SparkSession, sf: str, in_order: bool = True) -> DataFrame:
    """Orders with two category features and a 0/1 label from the price, dealt out for a fit unless told otherwise."""
    label = (F.col("o_totalprice") >= 250000).cast("double")
    rows = table(spark, sf, "orders")
    rows = dealt(rows, ["o_orderkey"]) if in_order else rows
    return rows.select("o_orderkey", *GROUP_COLUMNS, "o_totalprice", label.alias("label"))


GROUPED_ORDERS_SQL = """
g AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice,
         (o_totalprice >= 250000)::INT::DOUBLE AS label
  FROM orders)"""
