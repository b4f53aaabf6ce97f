"""Queries: renames, sentinels, casts, labels, row filters, appends, reports."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from millrace import functions as fn
from millrace.operators import clean
from millrace.plans.data import CLEAN_ORDERS_SQL, MARKED_ORDERS_SQL, SENTINEL, marked_orders, orders
from millrace.plans.registry import query, rounded
from millrace.sources import table


def _cleaned(spark, sf):
    return clean.null_sentinels(marked_orders(spark, sf), SENTINEL)


@query(
    "rename_all",
    """SELECT c_custkey AS id, c_name AS full_name, c_nationkey AS nation, c_acctbal AS balance,
              c_mktsegment AS segment FROM customer""",
)
def rename_all(spark, sf):
    return clean.rename_all(table(spark, sf, "customer"), ["id", "full_name", "nation", "balance", "segment"])


@query("null_sentinels", f"WITH {CLEAN_ORDERS_SQL} SELECT * FROM cleaned")
def null_sentinels(spark, sf):
    return _cleaned(spark, sf)


@query(
    "null_sentinel_one_column",
    f"""WITH {MARKED_ORDERS_SQL}
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority FROM marked""",
)
def null_sentinel_one_column(spark, sf):
    return clean.null_sentinels(marked_orders(spark, sf), SENTINEL, ["o_orderpriority"])


@query(
    "cast_columns",
    """SELECT o_orderkey, try_cast(o_orderpriority AS INT) AS o_orderpriority,
              try_cast(left(o_orderpriority, 1) AS DOUBLE) AS rank_text, o_custkey::VARCHAR AS o_custkey
       FROM orders""",
)
def cast_columns(spark, sf):
    text = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", F.left("o_orderpriority", F.lit(1)).alias("rank_text"), "o_custkey"
    )
    return clean.cast_columns(text, {"o_orderpriority": "int", "rank_text": "double", "o_custkey": "string"})


@query(
    "map_values",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS o_orderstatus FROM orders""",
)
def map_values(spark, sf):
    return clean.map_values(table(spark, sf, "orders"), "o_orderstatus", {"F": 1, "O": 0}).select(
        "o_orderkey", "o_orderstatus"
    )


@query("select_numeric", "SELECT p_partkey, p_size, p_retailprice FROM part")
def select_numeric(spark, sf):
    return clean.select_types(table(spark, sf, "part"), "numeric")


@query("select_string", "SELECT p_name, p_brand, p_type FROM part")
def select_string(spark, sf):
    return clean.select_types(table(spark, sf, "part"), "string")


@query("features_and_label", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def features_and_label(spark, sf):
    features, _ = clean.features_and_label(orders(spark, sf), "o_orderstatus")
    return features


@query(
    "threshold_label",
    """SELECT p_partkey, p_retailprice, try_cast(p_size::VARCHAR AS INT) >= 25 AS label FROM part""",
)
def threshold_label(spark, sf):
    text = table(spark, sf, "part").select("p_partkey", "p_retailprice", F.col("p_size").cast("string"))
    return clean.with_threshold_label(text, "p_size", 25)


@query(
    "union_labeled",
    """SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, 0.0::DOUBLE AS is_supplier FROM customer
       UNION ALL BY NAME
       SELECT s_suppkey AS id, s_acctbal AS balance, 1.0::DOUBLE AS is_supplier FROM supplier""",
)
def union_labeled(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id")
    )
    return clean.union_all(
        clean.with_literal(customers, "is_supplier", 0.0), clean.with_literal(suppliers, "is_supplier", 1.0)
    )


@query(
    "drop_incomplete",
    f"""WITH {CLEAN_ORDERS_SQL}
    SELECT * FROM cleaned WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL""",
)
def drop_incomplete(spark, sf):
    return clean.drop_incomplete(_cleaned(spark, sf))


@query("null_rows", f"WITH {CLEAN_ORDERS_SQL} SELECT * FROM cleaned WHERE o_orderpriority IS NULL")
def null_rows(spark, sf):
    return clean.null_rows(_cleaned(spark, sf), "o_orderpriority")


@query(
    "null_rows_all",
    f"""WITH {CLEAN_ORDERS_SQL}
    SELECT 'o_orderstatus' AS column_name, o_orderkey, o_totalprice FROM cleaned WHERE o_orderstatus IS NULL
    UNION ALL
    SELECT 'o_orderpriority', o_orderkey, o_totalprice FROM cleaned WHERE o_orderpriority IS NULL""",
)
def null_rows_all(spark, sf):
    return clean.null_rows_all(_cleaned(spark, sf)).select("column_name", "row.o_orderkey", "row.o_totalprice")


@query(
    "drop_outliers",
    """WITH f AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
    SELECT event_id, value FROM events, f
    WHERE NOT (value > q3 + 1.5 * (q3 - q1) OR value < q1 - 1.5 * (q3 - q1))""",
)
def drop_outliers(spark, sf):
    return clean.drop_outliers(table(spark, sf, "events"), "value").select("event_id", "value")


@query(
    "drop_outliers_with_nulls",
    """WITH e AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events),
    f AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM e)
    SELECT event_id, value FROM e, f
    WHERE value IS NULL OR NOT (value > q3 + 1.5 * (q3 - q1) OR value < q1 - 1.5 * (q3 - q1))""",
)
def drop_outliers_with_nulls(spark, sf):
    known = F.when(F.col("event_type") != "error", F.col("value"))
    events = table(spark, sf, "events").select("event_id", known.alias("value"))
    return clean.drop_outliers(events, "value")


@query("preview", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def preview(spark, sf):
    first = clean.preview(table(spark, sf, "orders"), 20, [F.desc("o_totalprice"), F.col("o_orderkey")])
    return first.select("o_orderkey", "o_totalprice")


@query(
    "schema_report",
    """SELECT * FROM (VALUES (0, 'p_partkey', 'bigint', true), (1, 'p_name', 'string', true),
    (2, 'p_brand', 'string', true), (3, 'p_type', 'string', true), (4, 'p_size', 'int', true),
    (5, 'p_retailprice', 'double', true)) AS t(position, column_name, type, nullable)""",
)
def schema_report(spark, sf):
    return clean.schema_report(table(spark, sf, "part"))


@query(
    "shape",
    """WITH f AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
    SELECT 'before' AS frame, count(*) AS n_rows, 6 AS n_columns FROM events
    UNION ALL
    SELECT 'after', count(*), 6 FROM events, f
    WHERE NOT (value > q3 + 1.5 * (q3 - q1) OR value < q1 - 1.5 * (q3 - q1))""",
)
def shape(spark, sf):
    events = table(spark, sf, "events")
    before = clean.shape(events).withColumn("frame", F.lit("before"))
    after = clean.shape(clean.drop_outliers(events, "value")).withColumn("frame", F.lit("after"))
    return before.unionByName(after)


@query(
    "positive_score",
    "SELECT l_returnflag, round(sum(l_discount), 6) AS score, count(*) AS n FROM lineitem GROUP BY l_returnflag",
)
def positive_score(spark, sf):
    """Probability vectors made from the discount; the second slot is read back."""
    vector = array_to_vector(F.array(1 - F.col("l_discount"), F.col("l_discount")))
    lines = table(spark, sf, "lineitem").select("l_returnflag", vector.alias("probability"))
    scores = lines.select("l_returnflag", fn.positive_score().alias("score"))
    summed = scores.groupBy("l_returnflag").agg(F.sum("score").alias("score"), F.count("*").alias("n"))
    return rounded(summed, "score")
