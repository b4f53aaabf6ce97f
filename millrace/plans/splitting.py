"""Queries: splits, samples and folds. Row order comes from a seeded md5, which SQL can repeat."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import split
from millrace.plans.registry import query
from millrace.sources import table

SEED = 42

_RANKED = """WITH r AS (SELECT o_orderkey, o_orderstatus, o_totalprice, count(*) OVER () AS n,
    row_number() OVER (ORDER BY md5(concat_ws('|', '42', o_orderkey::VARCHAR))) AS r FROM orders)"""


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    "split_exact",
    f"""{_RANKED} SELECT o_orderkey, o_orderstatus, o_totalprice,
    CASE WHEN r <= floor(0.8 * n) THEN 'train' ELSE 'test' END AS split FROM r""",
)
def split_exact(spark, sf):
    return split.split_exact(_orders(spark, sf), "o_orderkey", train=0.8, seed=SEED)


@query(
    "split_exact_test_size",
    f"""{_RANKED} SELECT o_orderkey, o_orderstatus, o_totalprice,
    CASE WHEN r <= n - ceil(0.3333 * n) THEN 'train' ELSE 'test' END AS split FROM r""",
)
def split_exact_test_size(spark, sf):
    return split.split_exact(_orders(spark, sf), "o_orderkey", test=0.3333, seed=SEED)


@query(
    "split_repeated_rows",
    """WITH d AS (SELECT l_returnflag, l_linestatus, count(*) AS c FROM lineitem GROUP BY ALL),
    o AS (SELECT *, md5(concat_ws('|', '42', l_returnflag, l_linestatus)) AS h FROM d),
    b AS (SELECT *, sum(c) OVER (ORDER BY h) - c AS before, sum(c) OVER () AS n FROM o),
    t AS (SELECT *, greatest(0, least(c, floor(0.8 * n) - before)) AS train FROM b)
    SELECT l_returnflag, l_linestatus, 'train' AS split, train::BIGINT AS n FROM t WHERE train > 0
    UNION ALL
    SELECT l_returnflag, l_linestatus, 'test', (c - train)::BIGINT FROM t WHERE c > train""",
)
def split_repeated_rows(spark, sf):
    """Six distinct rows, each repeated for a large share of the table; sizes are still exact."""
    flags = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus")
    parts = split.split_exact(flags, train=0.8, seed=SEED)
    return parts.groupBy("l_returnflag", "l_linestatus", "split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "split_counts",
    f"""{_RANKED} SELECT o_orderkey, o_orderstatus, o_totalprice,
    CASE WHEN r <= 9000 THEN 'train' ELSE 'validation' END AS split FROM r WHERE r <= 10000""",
)
def split_counts(spark, sf):
    return split.split_counts(_orders(spark, sf), "o_orderkey", 9000, 1000, seed=SEED)


@query("sample_n", f"{_RANKED} SELECT o_orderkey, o_orderstatus, o_totalprice FROM r WHERE r <= 1000")
def sample_n(spark, sf):
    return split.sample_n(_orders(spark, sf), "o_orderkey", 1000, seed=SEED)


@query(
    "split_sizes",
    f"""{_RANKED} SELECT CASE WHEN r <= floor(0.7 * n) THEN 'train' ELSE 'test' END AS split, count(*) AS n
    FROM r GROUP BY 1""",
)
def split_sizes(spark, sf):
    return split.split_sizes(split.split_exact(_orders(spark, sf), "o_orderkey", train=0.7, seed=SEED))


@query("split_random")
def split_random(spark, sf):
    train, test = split.split_random(_orders(spark, sf), [0.7, 0.3], seed=100)
    named = [part.withColumn("split", F.lit(name)) for part, name in ((train, "train"), (test, "test"))]
    return split.split_sizes(named[0].unionByName(named[1]))


@query(
    "folds",
    """SELECT o_orderkey, o_orderstatus, o_totalprice, (('0x' || substr(
      md5(concat_ws('|', '42', o_orderkey::VARCHAR)), 1, 12))::BIGINT % 5)::INT AS fold FROM orders""",
)
def folds(spark, sf):
    return split.assign_folds(_orders(spark, sf), "o_orderkey", 5, SEED)


@query(
    "folds_stratified",
    """SELECT o_orderkey, o_orderstatus, o_totalprice, ((row_number() OVER (ORDER BY o_orderstatus,
      md5(concat_ws('|', '42', o_orderkey::VARCHAR))) - 1) % 5)::INT AS fold FROM orders""",
)
def folds_stratified(spark, sf):
    return split.assign_folds(_orders(spark, sf), "o_orderkey", 5, SEED, stratify="o_orderstatus")
