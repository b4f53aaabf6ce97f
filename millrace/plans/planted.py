"""Queries over planted classes: orders whose class follows from their two categories, but for one in ten.

Models that can tell all category combinations apart must find the rule again, so SQL can say what they
predict on rows that they haven't seen, and what every metric is.
"""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from millrace.functions import positive_score
from millrace.operators import evaluate, features, models, split, tune
from millrace.plans.data import GROUP_COLUMNS, grouped_orders
from millrace.plans.files import _written_orders
from millrace.plans.modeling import ALL_CATEGORIES_APART
from millrace.plans.registry import query, rounded
from millrace.plans.splitting import SEED
from millrace.session import persisted
from millrace.sources import preview_lines, table

_RULE = "o_orderstatus = 'F' OR o_orderpriority = '1-URGENT'"

PLANTED_SQL = f"""
g AS (SELECT o_orderkey, o_orderstatus, o_orderpriority,
             (({_RULE}) <> (('0x' || substr(md5(o_orderkey::VARCHAR), 1, 4))::INT % 10 = 0))::INT::DOUBLE AS label,
             row_number() OVER (ORDER BY md5(concat_ws('|', '42', o_orderkey::VARCHAR))) AS r, count(*) OVER () AS n
      FROM orders)"""


def planted_orders(spark, sf):
    """Encoded orders with the planted label."""
    noise = F.conv(F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 4), 16, 10).cast("int") % 10 == 0
    rows = grouped_orders(spark, sf).withColumn("label", (F.expr(_RULE) != noise).cast("double"))
    return features.prepare(rows, features.feature_pipeline(GROUP_COLUMNS, [], None, drop_last=False), ["o_orderkey", *GROUP_COLUMNS])


def _apart(fit, **params):
    return lambda train: fit(train, max_depth=ALL_CATEGORIES_APART, **params)


_WHOLE = {"bootstrap": False, "featureSubsetStrategy": "all"}
_FITS = {
    "logistic": lambda train: models.fit_logistic(train, max_iter=50),
    "tree": _apart(models.fit_tree),
    "forest": _apart(models.fit_forest, n_estimators=3, **_WHOLE),
    "boosted": _apart(models.fit_gbt, n_estimators=3),
}


@query(
    "held_out_metrics",
    f"""WITH {PLANTED_SQL},
    m AS (SELECT o_orderstatus, o_orderpriority, avg(label) AS score FROM g WHERE r <= floor(0.7 * n)
          GROUP BY o_orderstatus, o_orderpriority),
    t AS (SELECT label, score, (score > 0.5)::INT::DOUBLE AS prediction FROM g JOIN m USING (o_orderstatus, o_orderpriority)
          WHERE r > floor(0.7 * n)),
    c AS (SELECT l.label, count(*) FILTER (t.label = l.label) AS support,
                 2 * count(*) FILTER (t.label = l.label AND t.prediction = l.label)
                 / (count(*) FILTER (t.label = l.label) + count(*) FILTER (t.prediction = l.label)) AS f1
          FROM t, (VALUES (0.0::DOUBLE), (1.0::DOUBLE)) l(label) GROUP BY l.label),
    f AS (SELECT sum(support * f1) / sum(support) AS f1 FROM c),
    a AS (SELECT avg((label = prediction)::INT) AS accuracy, count(*) AS n FROM t),
    s AS (SELECT score, sum(label) AS tp, sum(1 - label) AS fp FROM t GROUP BY score),
    u AS (SELECT tp, fp, sum(tp) OVER (ORDER BY score DESC) AS ctp, sum(tp) OVER () AS pos, sum(fp) OVER () AS neg FROM s),
    x AS (SELECT sum(fp / neg * (ctp - tp / 2) / pos) AS auc FROM u)
    SELECT model, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1,
           CASE WHEN model = 'boosted' THEN round(auc, 6) END AS roc_auc
    FROM (VALUES ('logistic'), ('tree'), ('forest'), ('boosted')) v(model), a, f, x""",
)
def held_out_metrics(spark, sf):
    """Accuracy, weighted F1 and exact area under the curve on rows that the models haven't seen.

    All find the classes. Only the boosted trees rank the groups by their shares: logistic weights add up over
    categories, and classification trees join leaves of one class. So only their area is compared.
    """
    found = None
    with persisted(split.split_exact(planted_orders(spark, sf), "o_orderkey", train=0.7, seed=SEED)) as parts:
        for name, fit in _FITS.items():
            pred = models.predict(fit(parts.filter("split = 'train'")), parts.filter("split = 'test'"))
            scored = pred.select("label", "prediction", positive_score().alias("score"))
            metrics = evaluate.class_metrics(scored).withColumn("model", F.lit(name))
            area = F.lit(None).cast("double")
            if name == "boosted":
                area = F.lit(evaluate.roc_auc(scored).first()["roc_auc"])
            row = metrics.select("model", "accuracy", "f1", area.alias("roc_auc"))
            found = row if found is None else found.unionByName(row)
    return rounded(found, "accuracy", "f1", "roc_auc")


@query(
    "best_model_scores",
    f"""WITH {PLANTED_SQL}
    SELECT o_orderstatus, o_orderpriority, (avg(label) > 0.5)::INT::DOUBLE AS prediction, count(*) AS n
    FROM g GROUP BY o_orderstatus, o_orderpriority""",
)
def best_model_scores(spark, sf):
    """The table scored by the best model of a cross-validated grid: the tree that may split."""
    rows = planted_orders(spark, sf)
    estimator = models.tree()
    points = tune.grid(estimator, {"max_depth": [0, ALL_CATEGORIES_APART]})
    evaluator = MulticlassClassificationEvaluator(metricName="accuracy")
    cv = tune.cross_validate(estimator, points, rows, "o_orderkey", evaluator, k=3, seed=SEED)
    pred = models.predict(cv.best_model, rows)
    return pred.groupBy(*GROUP_COLUMNS, "prediction").agg(F.count(F.lit(1)).alias("n"))


@query(
    "folds_odd_classes",
    r"""WITH c AS (SELECT CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'P' THEN '\N' ELSE o_orderstatus END AS kind FROM orders)
    SELECT kind, fold, count(*) // 5 AS least FROM c, (SELECT range::INT AS fold FROM range(5)) GROUP BY kind, fold""",
)
def folds_odd_classes(spark, sf):
    """Stratified folds where one class is NULL and one is the text of a NULL: each fold has a fifth of each."""
    kind = F.when(F.col("o_orderstatus") == "P", "\\N").when(F.col("o_orderstatus") != "F", F.col("o_orderstatus"))
    rows = table(spark, sf, "orders").select("o_orderkey", kind.alias("kind"))
    n = F.count(F.lit(1))
    dealt = split.assign_folds(rows, "o_orderkey", 5, SEED, stratify="kind").groupBy("kind", "fold").agg(n.alias("n"))
    fifth = rows.groupBy(F.col("kind").alias("_kind")).agg(F.floor(n / 5).alias("least"))
    both = dealt.join(fifth, F.col("kind").eqNullSafe(F.col("_kind")))
    return both.select("kind", "fold", F.when(F.col("n").between(F.col("least"), F.col("least") + 1), F.col("least")).alias("least"))


@query(
    "split_repeated_key",
    """SELECT CASE WHEN r <= floor(0.7 * n) THEN 'train' ELSE 'test' END AS split, count(*) AS n
    FROM (SELECT row_number() OVER () AS r, count(*) OVER () AS n FROM orders) GROUP BY 1""",
)
def split_repeated_key(spark, sf):
    """An exact split by a key that many rows share."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.split_sizes(split.split_exact(rows, "o_orderstatus", train=0.7, seed=SEED))


@query("split_random_parts", "SELECT count(*) AS n, 0::BIGINT AS shared, true AS near_share FROM orders")
def split_random_parts(spark, sf):
    """A random split loses no row, repeats none, and its first part is near its share (six standard deviations)."""
    rows = table(spark, sf, "orders").select("o_orderkey")
    first, second = split.split_random(rows, [0.7, 0.3], seed=100)
    both = first.withColumn("a", F.lit(1)).join(second.withColumn("b", F.lit(1)), "o_orderkey", "full")
    n, taken = F.count(F.lit(1)), F.count("a")
    near = F.abs(taken - 0.7 * n) <= 6 * F.sqrt(0.21 * n)
    return both.agg(n.alias("n"), F.count(F.col("a") + F.col("b")).alias("shared"), near.alias("near_share"))


@query("preview_lines_known", "SELECT 20::BIGINT AS shown, least(20, count(*)) AS known FROM orders")
def preview_lines_known(spark, sf):
    """The first lines of written orders are orders."""
    lines = preview_lines(spark, _written_orders(spark, sf), 20)
    key = F.split(F.col(lines.columns[-1]), ",")[0].cast("long")
    orders = table(spark, sf, "orders").select("o_orderkey", F.lit(1).alias("known"))
    found = lines.select(key.alias("o_orderkey")).join(orders, "o_orderkey", "left")
    return found.agg(F.count(F.lit(1)).alias("shown"), F.count("known").alias("known"))
