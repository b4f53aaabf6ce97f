"""Queries: dummy columns, category indices, one-hot vectors, assembled features."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from millrace.operators import features
from millrace.plans.data import ORDER_CATEGORIES, ORDER_NUMBERS, order_rows, orders
from millrace.plans.registry import at, query, rounded
from millrace.sources import table

# Category values of the given tables.
STATUSES = ["F", "O", "P"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _flags(column: str, values: list[str]) -> str:
    return ", ".join(f"coalesce(({column} = '{v}')::INT, 0) AS \"{column}_{v}\"" for v in values)


@query(
    "dummies",
    f"""SELECT o_orderkey, o_custkey, o_totalprice, {_flags('o_orderstatus', STATUSES)},
    {_flags('o_orderpriority', PRIORITIES)} FROM orders""",
)
def dummies(spark, sf):
    return features.dummies(orders(spark, sf))


def _positions(table_name: str, column: str) -> str:
    return f"""SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS i
    FROM {table_name} GROUP BY {column}"""


@query(
    "index_freq",
    f"""WITH s AS ({_positions('customer', 'c_mktsegment')})
    SELECT c_custkey, c_mktsegment, i::DOUBLE AS "c_mktsegmentIndex" FROM customer JOIN s USING (c_mktsegment)""",
)
def index_freq(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return features.index_categories(["c_mktsegment"]).fit(customers).transform(customers)


@query(
    "index_label",
    f"""WITH s AS ({_positions('orders', 'o_orderstatus')})
    SELECT o_orderkey, o_orderstatus, i::DOUBLE AS label FROM orders JOIN s USING (o_orderstatus)""",
)
def index_label(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return features.index_label("o_orderstatus").fit(rows).transform(rows)


@query(
    "index_by_table",
    """WITH s AS (SELECT o_custkey, row_number() OVER (ORDER BY count(*) DESC, o_custkey::VARCHAR) - 1 AS i FROM orders GROUP BY o_custkey)
    SELECT o_orderkey, o_custkey, i::DOUBLE AS "o_custkeyIndex" FROM orders JOIN s USING (o_custkey)""",
)
def index_by_table(spark, sf):
    """The index of a column of many levels, by a table of levels in place of a list on the driver."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return features.with_index(rows, "o_custkey", features.index_table(rows, "o_custkey"))


def _slots(n: int) -> str:
    return ", ".join(f"(i = {k})::INT::DOUBLE AS s{k}" for k in range(n))


@query(
    "one_hot",
    f"""WITH s AS ({_positions('customer', 'c_mktsegment')})
    SELECT c_custkey, 4 AS size, {_slots(4)} FROM customer JOIN s USING (c_mktsegment)""",
)
def one_hot(spark, sf):
    """Five segments, last one dropped: four slots."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    indexed = features.index_categories(["c_mktsegment"]).fit(customers).transform(customers)
    encoded = features.one_hot(["c_mktsegment"]).fit(indexed).transform(indexed)
    slots = vector_to_array("c_mktsegmentclassVec")
    return encoded.select("c_custkey", F.size(slots).alias("size"), *[at(slots, i).alias(f"s{i}") for i in range(4)])


@query(
    "assemble",
    f"""WITH st AS ({_positions('orders', 'o_orderstatus')}), pr AS ({_positions('orders', 'o_orderpriority')}),
    j AS (SELECT o_orderkey, o_totalprice, st.i AS si, pr.i AS pi FROM orders JOIN st USING (o_orderstatus)
          JOIN pr USING (o_orderpriority))
    SELECT o_orderkey, 7 AS size, {', '.join(f"(si = {k})::INT::DOUBLE AS x{k}" for k in range(2))},
    {', '.join(f"(pi = {k})::INT::DOUBLE AS x{k + 2}" for k in range(4))}, o_totalprice AS x6 FROM j""",
)
def assemble(spark, sf):
    """The whole feature pipeline: two slots for the status, four for the priority, the price last."""
    rows = orders(spark, sf)
    pipeline = features.feature_pipeline(["o_orderstatus", "o_orderpriority"], ["o_totalprice"])
    x = vector_to_array("features")
    out = pipeline.fit(rows).transform(rows)
    return out.select("o_orderkey", F.size(x).alias("size"), *[at(x, i).alias(f"x{i}") for i in range(7)])


def _level_sql(column: str, order: int) -> str:
    return f"""SELECT {order} AS c, '{column}classVec_' || {column} AS name,
        row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS i, count(*) OVER () AS levels,
        count(*) / (SELECT count(*) FROM r)::DOUBLE AS mean FROM r GROUP BY {column}"""


@query(
    "feature_slots",
    f"""WITH r AS (SELECT o_orderstatus, o_orderpriority, c_mktsegment, c_nationkey::VARCHAR AS nation, o_totalprice,
                         c_acctbal FROM orders JOIN customer ON o_custkey = c_custkey),
    l AS ({" UNION ALL ".join(_level_sql(c, i) for i, c in enumerate(ORDER_CATEGORIES))}),
    s AS (SELECT c, any_value(levels) - 1 AS slots FROM l GROUP BY c),
    o AS (SELECT c, sum(slots) OVER (ORDER BY c) - slots AS start, sum(slots) OVER () AS total FROM s)
    SELECT (start + i)::INT AS position, name, round(mean, 6) AS mean FROM l JOIN o USING (c) WHERE i < levels - 1
    UNION ALL SELECT (SELECT any_value(total) FROM o)::INT, 'o_totalprice', round(avg(o_totalprice), 6) FROM r
    UNION ALL SELECT (SELECT any_value(total) FROM o)::INT + 1, 'c_acctbal', round(avg(c_acctbal), 6) FROM r""",
)
def feature_slots(spark, sf):
    """Names of the vector slots of the training table, with the mean of each slot."""
    rows = order_rows(spark, sf)
    prepared = features.prepare(rows, features.feature_pipeline(ORDER_CATEGORIES, ORDER_NUMBERS))
    names = F.array(*[F.lit(n) for n in features.feature_names(prepared)])
    means = prepared.agg(vector_to_array(Summarizer.mean(F.col("features"))).alias("means"))
    slots = means.select(F.posexplode("means").alias("position", "mean"))
    named = slots.select("position", F.get(names, F.col("position")).alias("name"), "mean")
    return rounded(named, "mean")


@query("signature", "SELECT 'o_orderkey' AS first_input, 'label' AS first_output, count(*) AS n FROM orders")
def signature(spark, sf):
    rows = order_rows(spark, sf)
    text = features.signature(rows, rows.select("label"))
    name = "$.{}.fields[0].name"
    return rows.agg(F.count(F.lit(1)).alias("n")).select(
        F.get_json_object(F.lit(text), name.format("inputs")).alias("first_input"),
        F.get_json_object(F.lit(text), name.format("outputs")).alias("first_output"),
        "n",
    )
