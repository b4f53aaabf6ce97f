"""What the plans look like: pruned and pushed scans, few shuffles, bounded windows."""

import re

from pyspark.sql import functions as F

from millrace.operators import clean, evaluate, profile, rank, split
from millrace.plans.data import scored_lines
from millrace.sources import table


def plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_split_is_a_projection(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    text = plan(split.split_exact(orders, "o_orderkey", train=0.8, seed=1))
    assert "Exchange" not in text and "Window" not in text and "Sort" not in text
    assert "Exchange" not in plan(split.assign_folds(orders, "o_orderkey", 5, 1))
    assert "Exchange" not in plan(split.sample_n(orders, "o_orderkey", 10, 1))


def test_outlier_fences_reach_the_scan(spark, sf):
    text = plan(clean.drop_outliers(table(spark, sf, "events"), "value", keep_null=False).select("event_id"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(value", text)
    assert "ReadSchema: struct<event_id:bigint,value:double>" in text


def test_profiles_scan_once(spark, sf):
    orders = table(spark, sf, "orders")
    for df in (profile.null_counts(orders), clean.null_rows_all(orders), profile.incomplete_fraction(orders),
               evaluate.classification_report(orders.select(F.col("o_orderstatus").alias("label"),
                                                            F.col("o_orderstatus").alias("prediction")))):
        assert plan(df).count("FileScan") == 1


def test_class_metrics_read_two_columns(spark, sf):
    pred = table(spark, sf, "orders").withColumnsRenamed({"o_orderstatus": "label", "o_orderpriority": "prediction"})
    assert "ReadSchema: struct<o_orderstatus:string,o_orderpriority:string>" in plan(evaluate.class_metrics(pred))


def test_curves_read_the_scores_once(spark, sf):
    """What is left of the plan reads only the written counts."""
    for curve in (evaluate.roc_auc(scored_lines(spark, sf)), evaluate.roc_curve(scored_lines(spark, sf))):
        text = plan(curve)
        assert "lineitem.parquet" not in text and "millrace-" in text


def test_windows_are_partitioned_or_small(spark, sf):
    """The only unpartitioned windows run over the cells of the highest digit, after an aggregate by it."""
    text = plan(evaluate.roc_curve(scored_lines(spark, sf)))
    windows = re.findall(r"Window \[.*", text)
    assert windows and all("[at#" in w or "specifiedwindowframe(RowFrame, unboundedpreceding$(), unboundedfollowing$())" in w for w in windows)


def test_quantiles_shuffle_no_rows(spark, sf, tmp_path):
    """Every exchange by a group comes after a partial aggregate, and nothing asks for approximate quantiles."""
    plans = []
    write = rank.stored
    rank_stored = lambda df, name: plans.append(plan(df)) or write(df, name)
    lines = table(spark, sf, "lineitem")
    original, rank.stored = rank.stored, rank_stored
    try:
        profile.group_stats(lines, "l_returnflag", "l_extendedprice")
    finally:
        rank.stored = original
    assert len(plans) >= 2
    for text in plans:
        for block in re.findall(r"Exchange hashpartitioning\([^\n]*\n[^\n]*", text):
            assert "partial_" in block or "HashAggregate" in block, block
        assert "approx" not in text and "SortMergeJoin" not in text


def test_pair_bins_combine_before_the_shuffle(spark, sf):
    lines = table(spark, sf, "lineitem")
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_orderkey", "l_partkey", "l_suppkey"]
    text = plan(profile.pair_bins(lines, columns, "l_returnflag"))
    assert "Generate" not in text and text.index("HashAggregate") < text.index("MapInArrow")
