"""Headline timings. Prints one JSON line.

Environment: BENCH_SF_DIR (folder of tables), BENCH_CPUS (local cores), BENCH_ONLY (comma-separated
names, to time a few).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from millrace.operators import models, split, trees, tune  # noqa: E402
from millrace.plans import QUERIES  # noqa: E402
from millrace.plans.modeling import prepared_orders  # noqa: E402
from millrace.session import local_session, persisted  # noqa: E402
from millrace.sources import table  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
SEED = 100

HEADLINE = [
    "flagship",
    "null_sentinels",
    "drop_incomplete",
    "null_counts",
    "null_rows_all",
    "iqr_fences",
    "drop_outliers",
    "group_stats",
    "box_stats",
    "pair_bins",
    "count_by_sql",
    "dummies",
    "assemble",
    "split_exact",
    "split_repeated_rows",
    "folds_stratified",
    "report",
    "class_metrics",
    "roc_curve_lines",
    "roc_auc_lines",
    "evaluator_auc",
    "csv_infer",
    "csv_schema",
    "logistic_metrics",
    "tree_metrics",
    "forest_metrics",
    "gbt_metrics",
    "forest_regressor",
    "reload_equal",
    "search_runs",
    "parse_documents",
    "chat_messages",
    "render_turns",
    "pad_mask",
    "batch_infer",
]


def _cross_validation(make_estimator, values: dict):
    """A full grid with five folds on 70 % of the training table (150,000 x SF/0.1 rows before)."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        parts = split.split_exact(prepared_orders(spark, sf), "o_orderkey", train=0.7, seed=SEED)
        train = parts.filter("split = 'train'")
        estimator = make_estimator()
        points = tune.grid(estimator, values)
        return tune.cross_validate(estimator, points, train, "o_orderkey", k=5, seed=SEED, parallelism=CPUS, fit_partitions=1).table

    return run


def _search(spark: SparkSession, sf: str) -> DataFrame:
    """Sampled search over boosted trees, two trials at a time."""
    parts = split.split_exact(prepared_orders(spark, sf), "o_orderkey", test=0.2, seed=SEED)
    space = {
        "n_estimators": tune.QuantUniform(5, 20),
        "learning_rate": tune.LogUniform(-3, 0),
        "max_depth": tune.QuantUniform(2, 5),
    }
    train, test = parts.filter("split = 'train'"), parts.filter("split = 'test'")
    return tune.sampled_search(models.gbt, space, train, test, max_evals=8, parallelism=2, seed=SEED, fit_partitions=4).table


def _tree_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The published grid of depths and leaf sizes with five folds of equal class shares; depths share a fit."""
    values = {"max_depth": [None, 1, 2, 3, 4], "min_samples_leaf": list(range(1, 11))}
    return tune.grid_search(models.tree(), values, prepared_orders(spark, sf), "o_orderkey", k=5, seed=SEED, parallelism=CPUS, fit_partitions=1).table


def _boosted(spark: SparkSession, sf: str) -> DataFrame:
    """The published numbers of boosted trees, 100 and 200, scored on the same held-out rows from one fit."""
    parts = split.split_exact(prepared_orders(spark, sf), "o_orderkey", test=0.2, seed=SEED)
    with persisted(parts.select("label", "features", "split").coalesce(CPUS)) as kept:
        model = models.fit_gbt(kept.filter("split = 'train'"), n_estimators=200)
        return trees.staged_auc(model, kept.filter("split = 'test'"), [100, 200])


# The grids of the published examples.
TUNING = {
    "tree_grid_50x5": _tree_grid,
    "boosted_100_200": _boosted,
    "tree_cv_12x5": _cross_validation(models.tree, {"maxDepth": [1, 2, 6, 10], "maxBins": [20, 40, 80]}),
    "forest_cv_12x5": _cross_validation(
        models.forest, {"maxDepth": [2, 4, 6], "maxBins": [20, 60], "numTrees": [5, 20]}
    ),
    "logistic_cv_27x5": _cross_validation(
        models.logistic, {"regParam": [0.01, 0.5, 2.0], "elasticNetParam": [0.0, 0.5, 1.0], "maxIter": [1, 5, 10]}
    ),
    "sampled_search_8": _search,
}


def main() -> None:
    spark = local_session(CPUS, "millrace-bench", **{"spark.sql.shuffle.partitions": str(CPUS)})
    table(spark, SF_DIR, "lineitem").groupBy("l_returnflag").count().collect()  # start-up is not timed
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    timed = {name: QUERIES[name] for name in HEADLINE} | TUNING
    seconds: dict[str, float] = {}
    for name, run in timed.items():
        if only and name not in only:
            continue
        start = time.perf_counter()
        run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]} s", file=sys.stderr, flush=True)
    scale = re.search(r"sf([\d.]+)", SF_DIR)
    result = {
        "metric": "total seconds over headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else SF_DIR,
        "cpus": CPUS,
    }
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
