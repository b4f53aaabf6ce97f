"""Queries: cross-validation, grids and sampled search."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from millrace.operators import models, split, tune
from millrace.plans.data import GROUPED_ORDERS_SQL
from millrace.plans.modeling import ALL_CATEGORIES_APART, prepared_groups, prepared_orders
from millrace.plans.registry import query, rounded
from millrace.plans.splitting import SEED
from millrace.session import FEWEST_PARTITIONS, dealt, partitions_for
from millrace.sources import table

# Accuracy per fold of two predictors fitted on the other folds: the overall majority (a tree of
# depth 0) and the majority of each category combination (a tree that splits them all apart).
_CV_SQL = f"""WITH {GROUPED_ORDERS_SQL},
    d AS (SELECT o_orderstatus AS a, o_orderpriority AS b, label, {{fold}} AS fold FROM g),
    k AS (SELECT range::INT AS fold FROM range({{k}})),
    alone AS (SELECT k.fold, (avg(label) > 0.5)::INT::DOUBLE AS prediction
              FROM d JOIN k ON d.fold <> k.fold GROUP BY k.fold),
    apart AS (SELECT k.fold, a, b, (avg(label) > 0.5)::INT::DOUBLE AS prediction
              FROM d JOIN k ON d.fold <> k.fold GROUP BY k.fold, a, b)
    SELECT 0 AS point, fold, round(avg((label = prediction)::INT), 6) AS metric
    FROM d JOIN alone USING (fold) GROUP BY fold
    UNION ALL
    SELECT 1, fold, round(avg((label = prediction)::INT), 6) FROM d JOIN apart USING (fold, a, b) GROUP BY fold"""

_HASH_FOLD = "(('0x' || substr(md5(concat_ws('|', '42', o_orderkey::VARCHAR)), 1, 12))::BIGINT % {k})::INT"
_DEALT_FOLD = """((row_number() OVER (ORDER BY label, md5(concat_ws('|', '42', o_orderkey::VARCHAR))) - 1) % {k})::INT"""


def _accuracy():
    return MulticlassClassificationEvaluator(metricName="accuracy")


@query("cv_table", _CV_SQL.format(fold=_HASH_FOLD.format(k=5), k=5))
def cv_table(spark, sf):
    estimator = models.tree()
    points = tune.grid(estimator, {"max_depth": [0, ALL_CATEGORIES_APART]})
    cv = tune.cross_validate(estimator, points, prepared_groups(spark, sf), "o_orderkey", _accuracy(), k=5, seed=SEED)
    return rounded(cv.table, "metric").drop("params")


@query("grid_search", _CV_SQL.format(fold=_DEALT_FOLD.format(k=3), k=3))
def grid_search(spark, sf):
    """The same with folds of equal class shares and the common parameter names."""
    values = {"max_depth": [0, ALL_CATEGORIES_APART], "min_samples_leaf": [1]}
    found = tune.grid_search(
        models.tree(), values, prepared_groups(spark, sf), "o_orderkey", evaluator=_accuracy(), k=3, seed=SEED
    )
    return rounded(found.table, "metric").drop("params")


@query("cv_best")
def cv_best(spark, sf):
    """Best point of a small logistic grid by area under the curve, with its mean metric."""
    estimator = models.logistic()
    points = tune.grid(estimator, {"regParam": [0.01, 0.5], "elasticNetParam": [0.0, 0.5], "maxIter": [5]})
    cv = tune.cross_validate(estimator, points, prepared_orders(spark, sf), "o_orderkey", k=3, seed=SEED)
    mean = F.avg("metric").alias("mean_metric")
    means = cv.table.groupBy("point", F.to_json("params").alias("params")).agg(mean)
    return rounded(means, "mean_metric").withColumn("is_best", F.col("point") == cv.best_point)


@query("sampled_search")
def sampled_search(spark, sf):
    """The published search: 32 trials of boosted trees, with parameters drawn from quantised-uniform and log-uniform priors.

    A fit reads a task for about 200,000 rows; as many fits run at the same time as have eight tasks together, at least two.
    """
    parts = split.split_exact(prepared_orders(spark, sf), "o_orderkey", test=0.2, seed=SEED)
    space = {
        "n_estimators": tune.QuantUniform(20, 1000),
        "learning_rate": tune.LogUniform(-3, 0),
        "max_depth": tune.QuantUniform(2, 5),
    }
    few = partitions_for(table(spark, sf, "orders"), fewest=1)  # a small table is one task's, as many trees mean many jobs
    train, test = dealt(parts.filter("split = 'train'"), ["o_orderkey"], few), parts.filter("split = 'test'")
    at_once = max(2, FEWEST_PARTITIONS // few)
    found = tune.sampled_search(models.gbt, space, train, test, max_evals=32, parallelism=at_once, seed=SEED)
    trials = rounded(found.table, "auc", "loss")
    params = [F.round(trials["params"][n], 6).alias(n) for n in space]
    return trials.select("trial", *params, "auc", "loss", (F.col("auc") == F.lit(round(found.best_auc, 6))).alias("is_best"))



def _draw_sql(name: str) -> str:
    return f"""('0x' || substr(md5('42|' || trial || '|{name}'), 1, 13))::BIGINT / 16::DOUBLE ** 13"""


@query(
    "sampled_search_exact",
    f"""WITH {GROUPED_ORDERS_SQL},
    r AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', o_orderkey::VARCHAR))) AS r,
                 count(*) OVER () AS n FROM g),
    m AS (SELECT o_orderstatus, o_orderpriority, avg(label) AS score FROM r WHERE r <= n - ceil(0.2 * n)
          GROUP BY o_orderstatus, o_orderpriority),
    s AS (SELECT score, sum(label) AS tp, sum(1 - label) AS fp FROM r JOIN m USING (o_orderstatus, o_orderpriority)
          WHERE r > n - ceil(0.2 * n) GROUP BY score),
    c AS (SELECT tp, fp, sum(tp) OVER (ORDER BY score DESC) AS ctp, sum(tp) OVER () AS pos, sum(fp) OVER () AS neg FROM s),
    a AS (SELECT round(sum(fp / neg * (ctp - tp / 2) / pos), 6) AS auc FROM c),
    t AS (SELECT range::INT AS trial FROM range(4))
    SELECT trial, round_even(2 + 3 * {_draw_sql('n_estimators')}, 0) AS n_estimators,
           round(exp(-3 + 3 * {_draw_sql('learning_rate')}), 6) AS learning_rate, auc FROM t, a""",
)
def sampled_search_exact(spark, sf):
    """Trees that split all categories apart rank the groups by their training share of ones,
    whatever the drawn number of trees and rate; the area under the curve follows."""
    parts = split.split_exact(prepared_groups(spark, sf), "o_orderkey", test=0.2, seed=SEED)
    space = {"n_estimators": tune.QuantUniform(2, 5), "learning_rate": tune.LogUniform(-3, 0)}

    def apart(**params):
        return models.gbt(max_depth=ALL_CATEGORIES_APART, **params)

    train, test = parts.filter("split = 'train'"), parts.filter("split = 'test'")
    found = tune.sampled_search(apart, space, train, test, max_evals=4, parallelism=2, seed=SEED)
    params = [F.round(found.table["params"][n], 6).alias(n) for n in space]
    return rounded(found.table, "auc").select("trial", *params, "auc")
