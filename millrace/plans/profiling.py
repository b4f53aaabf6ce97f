"""Queries: counts, quartiles, group statistics, plot data."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import clean, profile
from millrace.plans.data import CLEAN_ORDERS_SQL, MARKED_ORDERS_SQL, SENTINEL, marked_orders
from millrace.plans.registry import query, rounded
from millrace.sources import register, sql, table


@query(
    "null_counts",
    f"""WITH {CLEAN_ORDERS_SQL}, n AS (SELECT
      count(*) FILTER (o_orderkey IS NULL) AS o_orderkey, count(*) FILTER (o_custkey IS NULL) AS o_custkey,
      count(*) FILTER (o_orderstatus IS NULL) AS o_orderstatus,
      count(*) FILTER (o_totalprice IS NULL) AS o_totalprice,
      count(*) FILTER (o_orderpriority IS NULL) AS o_orderpriority FROM cleaned)
    UNPIVOT n ON COLUMNS(*) INTO NAME column_name VALUE nulls""",
)
def null_counts(spark, sf):
    return profile.null_counts(clean.null_sentinels(marked_orders(spark, sf), SENTINEL))


@query(
    "sentinel_counts",
    f"""WITH {MARKED_ORDERS_SQL}, n AS (SELECT
      0::BIGINT AS o_orderkey, 0::BIGINT AS o_custkey,
      count(*) FILTER (o_orderstatus = '4-NOT SPECIFIED') AS o_orderstatus,
      0::BIGINT AS o_totalprice,
      count(*) FILTER (o_orderpriority = '4-NOT SPECIFIED') AS o_orderpriority FROM marked)
    UNPIVOT n ON COLUMNS(*) INTO NAME column_name VALUE hits""",
)
def sentinel_counts(spark, sf):
    return profile.value_counts_equal(marked_orders(spark, sf), SENTINEL)


@query(
    "incomplete_fraction",
    f"""WITH {CLEAN_ORDERS_SQL}
    SELECT round(avg((o_orderstatus IS NULL OR o_orderpriority IS NULL)::INT), 6) AS incomplete_fraction
    FROM cleaned""",
)
def incomplete_fraction(spark, sf):
    cleaned = clean.null_sentinels(marked_orders(spark, sf), SENTINEL)
    return rounded(profile.incomplete_fraction(cleaned), "incomplete_fraction")


@query(
    "group_stats",
    """SELECT l_returnflag, round(avg(l_extendedprice), 6) AS mean,
              round(quantile_cont(l_extendedprice, 0.5), 6) AS median,
              max(l_extendedprice) AS max, min(l_extendedprice) AS min
       FROM lineitem GROUP BY l_returnflag""",
)
def group_stats(spark, sf):
    return rounded(profile.group_stats(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice"), "mean", "median")


@query(
    "value_counts",
    "SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type",
)
def value_counts(spark, sf):
    return profile.value_counts(table(spark, sf, "events"), "event_type")


@query("distinct_values", "SELECT DISTINCT c_mktsegment FROM customer")
def distinct_values(spark, sf):
    return profile.distinct_values(table(spark, sf, "customer"), "c_mktsegment")


@query(
    "count_by_sql",
    """SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders
       GROUP BY o_orderpriority, o_orderstatus ORDER BY o_orderpriority, o_orderstatus""",
)
def count_by_sql(spark, sf):
    register(table(spark, sf, "orders"), "millrace_orders")
    return sql(
        spark,
        """SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM millrace_orders
           GROUP BY o_orderpriority, o_orderstatus ORDER BY o_orderpriority, o_orderstatus""",
    )


@query(
    "count_by",
    "SELECT l_quantity, l_returnflag, count(*) AS n FROM lineitem GROUP BY l_quantity, l_returnflag",
)
def count_by(spark, sf):
    return profile.count_by(table(spark, sf, "lineitem"), "l_quantity", "l_returnflag")


@query(
    "iqr_fences",
    """WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events),
    f AS (SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
    SELECT round(any_value(q1), 6) AS q1, round(any_value(q3), 6) AS q3, round(any_value(iqr), 6) AS iqr,
           round(any_value(lower), 6) AS lower, round(any_value(upper), 6) AS upper,
           round(avg((value > upper OR value < lower)::INT), 6) AS outlier_fraction
    FROM events, f""",
)
def iqr_fences(spark, sf):
    report = profile.iqr_report(table(spark, sf, "events"), "value")
    return rounded(report, "q1", "q3", "iqr", "lower", "upper", "outlier_fraction")


_BOX = """
    f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
    SELECT {key} round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
           min(value) FILTER (value BETWEEN lower AND upper) AS whisker_low,
           max(value) FILTER (value BETWEEN lower AND upper) AS whisker_high,
           count(*) FILTER (value NOT BETWEEN lower AND upper) AS n_outliers
    FROM events JOIN f {on}"""


@query(
    "box_stats",
    """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                         quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type),"""
    + _BOX.format(key="event_type,", on="USING (event_type) GROUP BY event_type"),
)
def box_stats(spark, sf):
    return rounded(profile.box_stats(table(spark, sf, "events"), "value", "event_type"), "q1", "median", "q3")


@query(
    "box_stats_all",
    """WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                         quantile_cont(value, 0.75) AS q3 FROM events),"""
    + _BOX.format(key="", on="ON true"),
)
def box_stats_all(spark, sf):
    return rounded(profile.box_stats(table(spark, sf, "events"), "value"), "q1", "median", "q3")


def _bin(c: str) -> str:
    return f"least(floor(({c} - lo_{c}) / ((hi_{c} - lo_{c}) / 10)), 9)::INT"


_PAIR_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "pair_bins",
    "WITH b AS (SELECT "
    + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in _PAIR_COLUMNS)
    + " FROM lineitem), d AS (SELECT l_returnflag, "
    + ", ".join(f"{_bin(c)} AS {c}" for c in _PAIR_COLUMNS)
    + " FROM lineitem, b) "
    + " UNION ALL ".join(
        f"SELECT l_returnflag, '{x}' AS x_col, '{y}' AS y_col, {x} AS x_bin, {y} AS y_bin, count(*) AS n "
        f"FROM d GROUP BY l_returnflag, {x}, {y}"
        for i, x in enumerate(_PAIR_COLUMNS)
        for y in _PAIR_COLUMNS[i:]
    ),
)
def pair_bins(spark, sf):
    return profile.pair_bins(table(spark, sf, "lineitem"), _PAIR_COLUMNS, "l_returnflag", 10)
