"""Queries: class metrics and curves on given scores and predictions."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from millrace.operators import evaluate
from millrace.plans.data import (
    RULED_ORDERS_SQL,
    SCORED_DOCUMENTS_SQL,
    SCORED_LINES_SQL,
    ruled_orders,
    scored_documents,
    scored_lines,
)
from millrace.plans.registry import query, rounded
from millrace.sources import table

_CLASSES = """
c AS (SELECT label, prediction, count(*) AS n FROM p GROUP BY label, prediction),
k AS (SELECT label AS class FROM c UNION SELECT prediction FROM c),
s AS (SELECT class,
        coalesce((SELECT sum(n) FROM c WHERE label = class), 0) AS support,
        coalesce((SELECT sum(n) FROM c WHERE prediction = class), 0) AS predicted,
        coalesce((SELECT sum(n) FROM c WHERE label = class AND prediction = class), 0) AS hits FROM k),
m AS (SELECT class, support, hits,
        coalesce(hits::DOUBLE / nullif(predicted, 0), 0) AS precision,
        coalesce(hits::DOUBLE / nullif(support, 0), 0) AS recall,
        coalesce(2.0::DOUBLE * hits / nullif(support + predicted, 0), 0) AS f1 FROM s)"""

_REPORT_SQL = f"""WITH {RULED_ORDERS_SQL}, {_CLASSES}
    SELECT class AS name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
           support::BIGINT AS support FROM m
    UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(hits)::DOUBLE / sum(support), 6), sum(support)::BIGINT FROM m
    UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
           sum(support)::BIGINT FROM m
    UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
           round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
           sum(support)::BIGINT FROM m"""


@query("confusion", f"WITH {RULED_ORDERS_SQL} SELECT label, prediction, count(*) AS n FROM p GROUP BY label, prediction")
def confusion(spark, sf):
    return evaluate.confusion_matrix(ruled_orders(spark, sf))


@query("report", _REPORT_SQL)
def report(spark, sf):
    table_form = evaluate.classification_report(ruled_orders(spark, sf))
    return rounded(table_form, "precision", "recall", "f1")


@query(
    "report_lines",
    f"""WITH r AS ({_REPORT_SQL})
    SELECT CASE name WHEN 'accuracy' THEN 1 WHEN 'macro avg' THEN 2 WHEN 'weighted avg' THEN 3 ELSE 0 END AS position,
           name, lpad(name, 14, ' ') || lpad(coalesce(printf('%.2f', precision), ''), 10, ' ')
           || lpad(coalesce(printf('%.2f', recall), ''), 10, ' ') || lpad(printf('%.2f', f1), 10, ' ')
           || lpad(support::VARCHAR, 10, ' ') AS line
    FROM r""",
)
def report_lines(spark, sf):
    return evaluate.report_lines(report(spark, sf))


@query(
    "accuracy",
    f"WITH {RULED_ORDERS_SQL} SELECT round(avg((label = prediction)::INT), 6) AS accuracy FROM p",
)
def accuracy(spark, sf):
    return rounded(evaluate.accuracy(ruled_orders(spark, sf)), "accuracy")


@query(
    "f1_weighted",
    f"WITH {RULED_ORDERS_SQL}, {_CLASSES} SELECT round(sum(f1 * support) / sum(support), 6) AS f1 FROM m",
)
def f1_weighted(spark, sf):
    return rounded(evaluate.f1_weighted(ruled_orders(spark, sf)), "f1")


@query(
    "class_metrics",
    f"""WITH {RULED_ORDERS_SQL}, {_CLASSES}
    SELECT round(sum(hits)::DOUBLE / sum(support), 6) AS accuracy, round(sum(f1 * support) / sum(support), 6) AS f1
    FROM m""",
)
def class_metrics(spark, sf):
    return rounded(evaluate.class_metrics(ruled_orders(spark, sf)), "accuracy", "f1")


@query(
    "mse",
    "SELECT round(avg(pow(l_extendedprice / 2000 - l_quantity, 2)), 6) AS mse FROM lineitem",
)
def mse(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        (F.col("l_extendedprice") / 2000).alias("label"), F.col("l_quantity").alias("prediction")
    )
    return rounded(evaluate.mse(lines), "mse")


_POINTS = """
s AS (SELECT score, sum(label) AS tp, sum(1 - label) AS fp FROM p GROUP BY score),
c AS (SELECT score, tp, fp, sum(tp) OVER w AS ctp, sum(fp) OVER w AS cfp, sum(tp) OVER () AS pos,
        sum(fp) OVER () AS neg, lead(tp) OVER (ORDER BY score DESC) AS ntp,
        lead(fp) OVER (ORDER BY score DESC) AS nfp, row_number() OVER (ORDER BY score DESC) AS r
      FROM s WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


def _roc_sql(source: str, where: str) -> str:
    return f"""WITH {source}, {_POINTS}
    SELECT round(cfp::DOUBLE / neg, 6) AS fpr, round(ctp::DOUBLE / pos, 6) AS tpr, score AS threshold
    FROM c WHERE {where}
    UNION ALL SELECT 0, 0, 'Infinity'::DOUBLE"""


_KEPT = "r = 1 OR ntp IS NULL OR ntp <> tp OR nfp <> fp"


@query("roc_curve", _roc_sql(SCORED_DOCUMENTS_SQL, _KEPT))
def roc_curve(spark, sf):
    return rounded(evaluate.roc_curve(scored_documents(spark, sf)), "fpr", "tpr")


@query("roc_curve_lines", _roc_sql(SCORED_LINES_SQL, _KEPT))
def roc_curve_lines(spark, sf):
    return rounded(evaluate.roc_curve(scored_lines(spark, sf)), "fpr", "tpr")


@query("roc_curve_all_points", _roc_sql(SCORED_LINES_SQL, "true"))
def roc_curve_all_points(spark, sf):
    return rounded(evaluate.roc_curve(scored_lines(spark, sf), drop_collinear=False), "fpr", "tpr")


def _auc_sql(source: str, name: str) -> str:
    return f"""WITH {source}, {_POINTS}
    SELECT round(sum((fp::DOUBLE / neg) * (ctp - tp / 2) / pos), 6) AS {name} FROM c"""


@query("roc_auc", _auc_sql(SCORED_DOCUMENTS_SQL, "roc_auc"))
def roc_auc(spark, sf):
    return rounded(evaluate.roc_auc(scored_documents(spark, sf)), "roc_auc")


@query("roc_auc_lines", _auc_sql(SCORED_LINES_SQL, "roc_auc"))
def roc_auc_lines(spark, sf):
    return rounded(evaluate.roc_auc(scored_lines(spark, sf)), "roc_auc")


@query(
    "evaluator_auc",
    f"""WITH {SCORED_LINES_SQL}, {_POINTS},
    x AS (SELECT r, ctp::DOUBLE / pos AS recall, ctp::DOUBLE / (ctp + cfp) AS precision,
                 (fp::DOUBLE / neg) * (ctp - tp / 2) / pos AS roc FROM c),
    y AS (SELECT roc, recall, precision, lag(recall, 1, 0) OVER (ORDER BY r) AS recall0,
                 lag(precision, 1, precision) OVER (ORDER BY r) AS precision0 FROM x)
    SELECT round(sum(roc), 6) AS roc, round(sum((recall - recall0) * (precision + precision0) / 2), 6) AS pr FROM y""",
)
def evaluator_auc(spark, sf):
    """Spark's evaluator without thinning, both metrics, on a raw score column."""
    score = F.col("score")
    pred = scored_lines(spark, sf).select(
        array_to_vector(F.array(-score, score)).alias("rawPrediction"), F.col("label").cast("double").alias("label")
    )
    found = {m: evaluate.evaluate_binary(pred, m, num_bins=0) for m in ("areaUnderROC", "areaUnderPR")}
    row = [(float(found["areaUnderROC"]), float(found["areaUnderPR"]))]
    return rounded(spark.createDataFrame(row, "roc double, pr double"), "roc", "pr")
