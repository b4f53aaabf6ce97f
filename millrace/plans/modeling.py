"""Queries: fitted models.

A tree that may split all categories apart predicts each category combination from that
combination's own rows, whatever order it splits in. SQL can say what those predictions are, which
gives several models an exact check.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.functions import positive_score
from millrace.operators import evaluate, features, models, split, trees
from millrace.plans.data import (
    GROUP_COLUMNS,
    GROUPED_ORDERS_SQL,
    ORDER_CATEGORIES,
    ORDER_NUMBERS,
    grouped_orders,
    joined_orders,
    order_rows,
)
from millrace.plans.registry import query, rounded
from millrace.plans.splitting import SEED
from millrace.session import dealt, partitions_for, persisted, scratch_path
from millrace.sources import load_model, register, save_model, sql, table

ALL_CATEGORIES_APART = 12  # depth that isolates 3 x 5 one-hot categories


def prepared_groups(spark, sf, label: str = "label"):
    rows = grouped_orders(spark, sf)
    if label != "label":
        rows = rows.withColumn("label", F.col(label))
    pipeline = features.feature_pipeline(GROUP_COLUMNS, [], None, drop_last=False)
    return features.prepare(rows, pipeline, ["o_orderkey", *GROUP_COLUMNS], grouped_orders(spark, sf, in_order=False))


def prepared_orders(spark, sf):
    pipeline = features.feature_pipeline(ORDER_CATEGORIES, ORDER_NUMBERS)
    return features.prepare(order_rows(spark, sf), pipeline, fit_on=joined_orders(spark, sf))


def _train_test(prepared):
    parts = split.split_exact(prepared, "o_orderkey", train=0.7, seed=SEED)
    return parts.filter("split = 'train'"), parts.filter("split = 'test'")


def _held_out(spark, sf, fit, **params):
    """Fit on 70 %, report class metrics and the exact area under the curve on the rest."""
    with persisted(prepared_orders(spark, sf)) as prepared:
        train, test = _train_test(prepared)
        pred = models.predict(fit(train, **params), test)
        with persisted(pred.select("label", "prediction", positive_score().alias("score"))) as scored:
            metrics = evaluate.class_metrics(scored).first()
            auc = evaluate.roc_auc(scored).first()["roc_auc"]
    row = [(metrics["accuracy"], metrics["f1"], auc)]
    return rounded(spark.createDataFrame(row, "accuracy double, f1 double, roc_auc double"), "accuracy", "f1", "roc_auc")


def flagship(spark, sf):
    """Price class of order lines: label, split, encode, fit, score, then a SQL count.

    No order line has a key of its own, so the split goes by all columns. It is a projection, and the
    final scoring does not read it. Only the rows that the fit reads are dealt out; cuts, categories and scores come
    from the table as it lies.
    """
    lines = table(spark, sf, "lineitem")
    order = ["l_orderkey", "l_linenumber"]
    labelled = lines.withColumn("label", (F.col("l_extendedprice") >= 50000).cast("double"))
    parts = split.split_exact(labelled, lines.columns, train=0.7, seed=SEED)
    pipeline = features.feature_pipeline(["l_returnflag", "l_linestatus"], ["l_quantity", "l_discount", "l_tax"])
    prepared = features.prepare(parts, pipeline, ["l_returnflag", "split", *order])
    train = dealt(prepared.filter("split = 'train'"), order, partitions_for(lines)).select("label", "features")
    with persisted(train) as kept:
        model = models.fit_logistic(kept, maxIter=10)
    scored = models.predict(model, prepared, ["l_returnflag", "prediction"])
    register(scored, "millrace_scored")
    return sql(
        spark,
        """SELECT l_returnflag, prediction, count(*) AS count FROM millrace_scored
           GROUP BY l_returnflag, prediction ORDER BY l_returnflag, prediction""",
    )


@query("flagship")
def flagship_query(spark, sf):
    return flagship(spark, sf)


_MAJORITY_SQL = f"""WITH {GROUPED_ORDERS_SQL}
    SELECT o_orderstatus, o_orderpriority, (avg(label) > 0.5)::INT::DOUBLE AS prediction, count(*) AS n
    FROM g GROUP BY o_orderstatus, o_orderpriority"""


def _by_group(pred, *columns):
    return pred.groupBy(*GROUP_COLUMNS, *columns).agg(F.count(F.lit(1)).alias("n"))


@query("tree_predictions", _MAJORITY_SQL)
def tree_predictions(spark, sf):
    prepared = prepared_groups(spark, sf)
    model = models.fit_tree(prepared, max_depth=ALL_CATEGORIES_APART)
    return _by_group(models.predict(model, prepared), "prediction")


@query("tree_predictions_entropy", _MAJORITY_SQL)
def tree_predictions_entropy(spark, sf):
    prepared = prepared_groups(spark, sf)
    model = models.fit_tree(prepared, max_depth=None, criterion="entropy", min_samples_leaf=1)
    return _by_group(models.predict(model, prepared), "prediction")


@query("forest_predictions", _MAJORITY_SQL)
def forest_predictions(spark, sf):
    """Without resampling of rows or columns every tree of the forest is the same full tree."""
    prepared = prepared_groups(spark, sf)
    options = {"bootstrap": False, "featureSubsetStrategy": "all"}
    model = models.fit_forest(prepared, n_estimators=3, max_depth=ALL_CATEGORIES_APART, **options)
    return _by_group(models.predict(model, prepared), "prediction")


@query(
    "forest_regressor",
    f"""WITH {GROUPED_ORDERS_SQL}
    SELECT o_orderstatus, o_orderpriority, round(avg(o_totalprice), 4) AS prediction, count(*) AS n
    FROM g GROUP BY o_orderstatus, o_orderpriority""",
)
def forest_regressor(spark, sf):
    prepared = prepared_groups(spark, sf, "o_totalprice")
    options = {"bootstrap": False, "featureSubsetStrategy": "all"}
    model = models.fit_forest_regressor(prepared, n_estimators=2, max_depth=ALL_CATEGORIES_APART, **options)
    return _by_group(rounded(models.predict(model, prepared), "prediction", digits=4), "prediction")


@query(
    "gbt_probabilities",
    f"""WITH {GROUPED_ORDERS_SQL}, y AS (SELECT o_orderstatus, o_orderpriority, 2 * label - 1 AS y FROM g),
    f1 AS (SELECT o_orderstatus, o_orderpriority, y, avg(y) OVER w AS f FROM y
           WINDOW w AS (PARTITION BY o_orderstatus, o_orderpriority)),
    f2 AS (SELECT o_orderstatus, o_orderpriority, y, f + 0.1::DOUBLE * avg(4 * y / (1 + exp(2 * y * f))) OVER w AS f
           FROM f1 WINDOW w AS (PARTITION BY o_orderstatus, o_orderpriority)),
    f3 AS (SELECT o_orderstatus, o_orderpriority, y, f + 0.1::DOUBLE * avg(4 * y / (1 + exp(2 * y * f))) OVER w AS f
           FROM f2 WINDOW w AS (PARTITION BY o_orderstatus, o_orderpriority))
    SELECT o_orderstatus, o_orderpriority, round(1 / (1 + exp(-2 * any_value(f))), 6) AS score, count(*) AS n
    FROM f3 GROUP BY o_orderstatus, o_orderpriority""",
)
def gbt_probabilities(spark, sf):
    """Three boosting steps: the mean target, then twice a tenth of the mean loss gradient."""
    prepared = prepared_groups(spark, sf)
    model = models.fit_gbt(prepared, n_estimators=3, learning_rate=0.1, max_depth=ALL_CATEGORIES_APART)
    scored = models.predict(model, prepared).withColumn("score", F.round(positive_score(), 6))
    return _by_group(scored, "score")


@query(
    "residuals",
    f"""WITH {GROUPED_ORDERS_SQL}, c AS (
      SELECT 'o_orderstatus' AS feature, o_orderstatus AS category, label FROM g
      UNION ALL SELECT 'o_orderpriority', o_orderpriority, label FROM g)
    SELECT feature, category, round(avg(label), 3) AS fitted, 0.0::DOUBLE AS residual, count(*) AS n
    FROM c GROUP BY feature, category""",
)
def residuals(spark, sf):
    """A fitted logistic model meets the label mean of every category, so residuals average 0."""
    prepared = prepared_groups(spark, sf)
    pred = models.predict(models.fit_logistic(prepared, tol=1e-10, max_iter=200), prepared)
    view = models.fitted_vs_residuals(pred, keep=GROUP_COLUMNS)
    both = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("category")) for c in GROUP_COLUMNS])
    return (
        view.withColumn("c", F.explode(both))
        .groupBy("c.feature", "c.category")
        .agg(
            F.round(F.avg("fitted"), 3).alias("fitted"),
            F.abs(F.round(F.avg("residual"), 3)).alias("residual"),
            F.count(F.lit(1)).alias("n"),
        )
    )


@query("logistic_metrics")
def logistic_metrics(spark, sf):
    return _held_out(spark, sf, models.fit_logistic, maxIter=10)


@query("logistic_default_metrics")
def logistic_default_metrics(spark, sf):
    return _held_out(spark, sf, models.fit_logistic, C=1.0, max_iter=100)


@query("tree_metrics")
def tree_metrics(spark, sf):
    return _held_out(spark, sf, models.fit_tree, max_depth=3)


@query("forest_metrics")
def forest_metrics(spark, sf):
    return _held_out(spark, sf, models.fit_forest, random_state=SEED)


@query("gbt_metrics")
def gbt_metrics(spark, sf):
    return _held_out(spark, sf, models.fit_gbt, n_estimators=10)


@query("coefficients")
def coefficients(spark, sf):
    prepared = prepared_orders(spark, sf)
    model = models.fit_logistic(prepared, maxIter=10)
    return models.coefficients_table(model, features.feature_names(prepared))


@query(
    "coefficients_one_category",
    f"""WITH {GROUPED_ORDERS_SQL},
    p AS (SELECT o_orderstatus AS name, ln(avg(label) / (1 - avg(label))) AS logit,
                 row_number() OVER (ORDER BY count(*) DESC, o_orderstatus) - 1 AS i, count(*) OVER () AS levels
          FROM g GROUP BY o_orderstatus)
    SELECT -1 AS position, '(intercept)' AS name, round(logit, 4) AS weight FROM p WHERE i = levels - 1
    UNION ALL
    SELECT i::INT, 'o_orderstatusclassVec_' || name, round(logit - (SELECT logit FROM p WHERE i = levels - 1), 4)
    FROM p WHERE i < levels - 1""",
)
def coefficients_one_category(spark, sf):
    """With one category as the only feature the weights are differences of log odds."""
    rows = grouped_orders(spark, sf)
    prepared = features.prepare(rows, features.feature_pipeline(["o_orderstatus"], []), [])
    model = models.fit_logistic(prepared, tol=1e-12, max_iter=500)
    weights = models.coefficients_table(model, features.feature_names(prepared))
    return rounded(weights, "weight", digits=4)


_SPLITS_SQL = ", ".join(
    f"({k}, '{column}', '{value}')"
    for k, (column, value) in enumerate(
        [("o_orderstatus", v) for v in ("F", "O", "P")]
        + [("o_orderpriority", v) for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")]
    )
)


@query(
    "tree_nodes_first_split",
    f"""WITH {GROUPED_ORDERS_SQL}, c(k, col, val) AS (VALUES {_SPLITS_SQL}),
    m AS (SELECT val, CASE col WHEN 'o_orderstatus' THEN o_orderstatus ELSE o_orderpriority END = val AS inside,
                 o_totalprice AS y FROM g, c),
    s AS (SELECT val, inside, count(*) AS n, avg(y) AS mean, var_pop(y) AS spread FROM m GROUP BY val, inside),
    t AS (SELECT count(*) AS n, avg(o_totalprice) AS mean, var_pop(o_totalprice) AS spread FROM g),
    b AS (SELECT val, t.spread - sum(s.n * s.spread) / t.n AS gain FROM s, t GROUP BY val, t.spread, t.n
          ORDER BY gain DESC LIMIT 1)
    SELECT 0 AS node, round(t.mean, 4) AS prediction, round(t.spread / 1e6, 4) AS impurity,
           round(b.gain / 1e6, 4) AS gain, b.val AS split_value FROM t, b
    UNION ALL
    SELECT (row_number() OVER (ORDER BY s.mean))::INT, round(s.mean, 4), round(s.spread / 1e6, 4), NULL, NULL FROM s JOIN b USING (val)""",
)
def tree_nodes_first_split(spark, sf):
    """The first split of a regression tree is the category value with the largest variance drop.

    Of the two sides Spark puts the one with the lower mean on the left.
    """
    rows = grouped_orders(spark, sf).withColumn("label", F.col("o_totalprice"))
    prepared = features.prepare(rows, features.feature_pipeline(GROUP_COLUMNS, [], drop_last=False), [])
    options = {"bootstrap": False, "featureSubsetStrategy": "all"}
    nodes = models.tree_nodes(models.fit_forest_regressor(prepared, n_estimators=1, max_depth=1, **options))
    names = F.array(*[F.lit(n.split("classVec_")[1]) for n in features.feature_names(prepared)])
    return nodes.select(
        "node",
        F.round("prediction", 4).alias("prediction"),
        F.round(F.col("impurity") / 1e6, 4).alias("impurity"),
        F.when(F.col("left_child").isNotNull(), F.round(F.col("gain") / 1e6, 4)).alias("gain"),
        F.get(names, F.col("feature")).alias("split_value"),
    )


@query("tree_summary")
def tree_summary(spark, sf):
    return models.tree_summary(models.fit_forest(prepared_orders(spark, sf), n_estimators=5, random_state=SEED))


@query("tree_nodes")
def tree_nodes(spark, sf):
    return models.tree_nodes(models.fit_tree(prepared_orders(spark, sf), max_depth=3))


@query("tree_walk", _MAJORITY_SQL)
def tree_walk(spark, sf):
    """Rows walked through the saved nodes of a full tree, without the model: the leaves' classes."""
    prepared = prepared_groups(spark, sf)
    nodes = models.tree_nodes(models.fit_tree(prepared, max_depth=ALL_CATEGORIES_APART))
    walked = trees.walk(prepared.select("features", *GROUP_COLUMNS), nodes)
    return _by_group(walked.join(nodes.select("node", "prediction"), "node"), "prediction")


@query(
    "tree_sizes",
    f"""WITH {GROUPED_ORDERS_SQL} SELECT true AS one_more_leaf, true AS all_rows, true AS deep_enough""",
)
def tree_sizes(spark, sf):
    """What the node table and the summary of a tree say of each other: leaves are inner nodes and one; the leaves hold
    all rows; the depth is that of the deepest node."""
    with persisted(prepared_groups(spark, sf)) as prepared:
        model = models.fit_tree(prepared, max_depth=ALL_CATEGORIES_APART)
        nodes, summary = models.tree_nodes(model), models.tree_summary(model).first()
        walked, n = trees.walk(prepared.select("features"), nodes).groupBy("node").count(), prepared.count()
        reached = walked.agg(F.sum("count")).first()[0]
    leaf = F.col("left_child").isNull()
    counts = nodes.agg(F.count_if(leaf).alias("leaves"), F.count_if(~leaf).alias("inner"), F.count("*").alias("all"))
    depth = F.lit(summary["depth"])
    return counts.select(
        ((F.col("leaves") == F.col("inner") + 1) & (F.col("all") == summary["n_nodes"])).alias("one_more_leaf"),
        F.lit(reached == n).alias("all_rows"),
        ((F.ceil(F.log2(F.col("leaves"))) <= depth) & (depth < F.col("leaves"))).alias("deep_enough"),
    )


STAGES = (1, 2, 10, 60)


@query(
    "gbt_staged",
    f"""WITH RECURSIVE {GROUPED_ORDERS_SQL},
    y AS (SELECT o_orderstatus, o_orderpriority, avg(label) AS p, count(*) AS n FROM g GROUP BY o_orderstatus, o_orderpriority),
    f AS (SELECT o_orderstatus, o_orderpriority, p, n, 1 AS n_trees, 2 * p - 1 AS f FROM y
          UNION ALL
          SELECT o_orderstatus, o_orderpriority, p, n, n_trees + 1,
                 f + 0.1::DOUBLE * (4 * p / (1 + exp(2 * f)) - 4 * (1 - p) / (1 + exp(-2 * f)))
          FROM f WHERE n_trees < {STAGES[-1]})
    SELECT o_orderstatus, o_orderpriority, n_trees, round(f, 4) AS margin, n FROM f WHERE n_trees IN {STAGES}""",
)
def gbt_staged(spark, sf):
    """Margins after several numbers of boosted trees, all from one fit: a step of each is a tenth of the mean gradient."""
    prepared = prepared_groups(spark, sf)
    few = partitions_for(table(spark, sf, "orders"), fewest=1)  # a small table is one task's, as many trees mean many jobs
    with persisted(prepared.coalesce(few)) as kept:
        model = models.fit_gbt(kept, n_estimators=STAGES[-1], max_depth=ALL_CATEGORIES_APART)
    margins = trees.staged_margins(model, prepared, STAGES, GROUP_COLUMNS).withColumn("margin", F.round("margin", 4))
    return margins.groupBy(*GROUP_COLUMNS, "n_trees", "margin").agg(F.count(F.lit(1)).alias("n"))


@query("param_table")
def param_table(spark, sf):
    """Parameters of a model fitted on the given tables."""
    return models.param_table(models.fit_logistic(prepared_groups(spark, sf), maxIter=10))


@query("reload_equal", "SELECT 0::BIGINT AS differences, count(*) AS n FROM orders")
def reload_equal(spark, sf):
    """Predictions of a saved and reloaded model against the original, both ways round."""
    with persisted(prepared_orders(spark, sf)) as prepared:
        model = models.fit_forest(prepared, n_estimators=5, random_state=SEED)
        again = load_model(save_model(model, scratch_path(spark, "model")))

        def answers(m):
            probability = vector_to_array("probability").alias("p")
            return models.predict(m, prepared).select("o_orderkey", "prediction", probability)

        old, new = answers(model), answers(again)
        n = old.count()
        differences = old.exceptAll(new).unionAll(new.exceptAll(old)).count()
    return spark.createDataFrame([(differences, n)], "differences long, n long")
