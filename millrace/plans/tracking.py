"""Queries: run and model tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import evaluate, models, runs
from millrace.plans.data import GROUPED_ORDERS_SQL, RULED_ORDERS_SQL, ruled_orders
from millrace.plans.modeling import ALL_CATEGORIES_APART, prepared_groups
from millrace.plans.registry import query, rounded
from millrace.session import scratch_path
from millrace.sources import table


@query(
    "search_runs",
    """SELECT o_orderkey::VARCHAR AS run_id, o_totalprice AS test_auc FROM orders
       ORDER BY CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END DESC NULLS LAST, o_orderdate DESC, run_id
       LIMIT 10""",
)
def search_runs(spark, sf):
    """Orders seen as runs; runs of one status lack the metric and come last."""
    orders = table(spark, sf, "orders")
    metric = F.when(F.col("o_orderstatus") != "P", F.create_map(F.lit("test_auc"), F.col("o_totalprice")))
    seen = orders.select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderdate").alias("start_time"),
        F.coalesce(metric, F.create_map(F.lit("other"), F.lit(1.0))).alias("metrics"),
    )
    best = runs.search_runs(seen, ["metrics.test_auc DESC", "start_time DESC", "run_id ASC"], 10)
    return best.select("run_id", F.try_element_at("metrics", F.lit("test_auc")).alias("test_auc"))


_MAJORITY_ACCURACY = f"""WITH {GROUPED_ORDERS_SQL},
    m AS (SELECT label, (avg(label) OVER (PARTITION BY o_orderstatus, o_orderpriority) > 0.5)::INT::DOUBLE
                 AS prediction FROM g)"""


@query(
    "register_model",
    f"""{_MAJORITY_ACCURACY}
    SELECT 'price class' AS name, v.version::INT AS version, 'child' AS run_name, 'parent' AS parent_name,
           '12' AS max_depth, round(avg((label = prediction)::INT), 6) AS accuracy
    FROM m, range(1, 3) v(version) GROUP BY v.version""",
)
def register_model(spark, sf):
    """Two fits recorded under a parent run and registered under one name."""
    prepared = prepared_groups(spark, sf)
    root = scratch_path(spark, "tracking")
    parent = runs.log_run(spark, root, run_name="parent")
    for _ in range(2):
        model = models.fit_tree(prepared, max_depth=ALL_CATEGORIES_APART)
        found = evaluate.accuracy(models.predict(model, prepared)).first()["accuracy"]
        run = runs.log_run(
            spark, root, run_name="child", model=model, metrics={"accuracy": found}, parent_run_id=parent
        )
        runs.register_model(spark, root, "price class", run)
    recorded = runs.runs_table(spark, root)
    parents = recorded.select(F.col("run_id").alias("parent_run_id"), F.col("run_name").alias("parent_name"))
    joined = runs.models_table(spark, root).join(recorded, "run_id").join(parents, "parent_run_id")
    return rounded(
        joined.select(
            "name",
            "version",
            "run_name",
            "parent_name",
            F.col("params")["maxDepth"].alias("max_depth"),
            F.col("metrics")["accuracy"].alias("accuracy"),
        ),
        "accuracy",
    )


@query(
    "load_run_model",
    f"""WITH {GROUPED_ORDERS_SQL}
    SELECT o_orderkey, (avg(label) OVER (PARTITION BY o_orderstatus, o_orderpriority) > 0.5)::INT::DOUBLE
           AS prediction FROM g""",
)
def load_run_model(spark, sf):
    """The best recorded run's model, loaded by run id, scores the table."""
    prepared = prepared_groups(spark, sf)
    root = scratch_path(spark, "tracking")
    for depth in (0, ALL_CATEGORIES_APART):
        model = models.fit_tree(prepared, max_depth=depth)
        found = evaluate.accuracy(models.predict(model, prepared)).first()["accuracy"]
        runs.log_run(spark, root, run_name=f"depth {depth}", model=model, metrics={"test_auc": found})
    best = runs.best_run(runs.runs_table(spark, root))
    return models.predict(runs.load_run_model(spark, root, best["run_id"]), prepared, ["o_orderkey", "prediction"])


@query(
    "run_metrics",
    f"""WITH {RULED_ORDERS_SQL} SELECT 'report' AS run_name, round(avg((label = prediction)::INT), 6) AS accuracy,
    7::INT AS n_metrics FROM p""",
)
def run_metrics(spark, sf):
    """Metrics of a classification report in a run record."""
    root = scratch_path(spark, "tracking")
    report = evaluate.classification_report(ruled_orders(spark, sf))
    runs.log_run(spark, root, run_name="report", metrics=runs.report_metrics(report))
    recorded = runs.runs_table(spark, root)
    found = recorded.select(
        "run_name", F.col("metrics")["accuracy"].alias("accuracy"), F.size("metrics").alias("n_metrics")
    )
    return rounded(found, "accuracy")
