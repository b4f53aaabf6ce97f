"""Parameter grids, cross-validation and sampled search.

Every fit is a data-parallel Spark job; several fits run at the same time from a few driver
threads. The prepared table is persisted once and all fits read it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import trees
from millrace.operators.evaluate import evaluate_binary
from millrace.operators.models import spark_params
from millrace.operators.runs import log_run, new_run_id
from millrace.operators.split import assign_folds
from millrace.session import persisted, shared_dir


def grid(estimator: Estimator, values: Mapping[str, Sequence]) -> list[dict]:
    """All combinations of parameter values, as param maps of the estimator."""
    builder = ParamGridBuilder()
    for name, choices in values.items():
        # The number of trees; iterations of a model without trees are not meant by it.
        names = ("numTrees", "maxIter") if estimator.hasParam("maxDepth") else ()
        ensemble_size = next((n for n in names if estimator.hasParam(n)), None)
        translated = [spark_params({name: c}, ensemble_size) for c in choices]
        if not all(translated):
            continue
        (spark_name,) = {n for t in translated for n in t}
        builder = builder.addGrid(estimator.getParam(spark_name), [t[spark_name] for t in translated])
    return builder.build()


def _as_text(param_map: Mapping) -> dict[str, str]:
    return {p.name: str(v) for p, v in param_map.items()}


def _in_threads(spark: SparkSession, tasks: Sequence[Callable], parallelism: int) -> list:
    if parallelism <= 1:
        return [task() for task in tasks]
    pool = ThreadPool(min(parallelism, max(len(tasks), 1)))
    try:
        return pool.map(lambda task: task(), [inheritable_thread_target(spark)(t) for t in tasks], chunksize=1)
    finally:
        pool.close()


def _tasks(kept: DataFrame, fit_partitions: int | None) -> DataFrame:
    return kept if fit_partitions is None else kept.coalesce(fit_partitions)


@dataclass(frozen=True)
class CrossValidation:
    """``table`` has one row per grid point and fold: ``point, params, fold, metric``."""

    best_model: Model
    best_point: int
    best_params: dict[str, str]
    mean_metrics: list[float]
    table: DataFrame


def cross_validate(
    estimator: Estimator,
    param_maps: Sequence[Mapping],
    df: DataFrame,
    key: str | Sequence[str],
    evaluator: Evaluator | None = None,
    k: int = 5,
    seed: int = 0,
    stratify: str | None = None,
    parallelism: int = 4,
    fit_partitions: int | None = None,
) -> CrossValidation:
    """k-fold cross-validation over a grid; the best point is fitted again on all rows.

    Points of a classification tree that differ in depth alone share a fit: the deepest tree, cut off (``trees``).
    ``key`` identifies a row and decides its fold. The evaluator is the area under Spark's thinned ROC
    curve unless given. ``fit_partitions`` lets a fit on a small table use fewer tasks.
    """
    evaluator = BinaryClassificationEvaluator() if evaluator is None else evaluator
    folded = assign_folds(df, key, k, seed, stratify, column="_fold").select("label", "features", "_fold")
    shared = _by_depth(estimator, param_maps, evaluator)
    with persisted(folded) as kept:
        data = _tasks(kept, fit_partitions)

        def trial(points: list[int], fold: int) -> Callable:
            def run() -> list[tuple[int, int, float]]:
                test = data.filter(F.col("_fold") == fold)
                model = estimator.fit(data.filter(F.col("_fold") != fold), dict(param_maps[points[-1]]))
                if len(points) == 1:
                    return [(points[0], fold, evaluator.evaluate(model.transform(test)))]
                weighted = evaluator.copy({evaluator.weightCol: trees.ROWS})
                depths = {p: _depth_of(estimator, param_maps[p]) for p in points}
                scored = trees.scored_at_depths(model, test, sorted(set(depths.values())))
                found = {depth: weighted.evaluate(rows) for depth, rows in scored.items()}
                return [(p, fold, found[depths[p]]) for p in points]

            return run

        done = _in_threads(df.sparkSession, [trial(points, fold) for points in shared for fold in range(k)], parallelism)
        metrics = {(point, fold): m for part in done for point, fold, m in part}
        means = [sum(metrics[point, fold] for fold in range(k)) / k for point in range(len(param_maps))]
        pick = max if evaluator.isLargerBetter() else min
        best = means.index(pick(means))
        best_model = estimator.fit(data, dict(param_maps[best]))
    rows = [(point, _as_text(param_maps[point]), fold, float(m)) for (point, fold), m in sorted(metrics.items())]
    table = df.sparkSession.createDataFrame(rows, "point int, params map<string,string>, fold int, metric double")
    return CrossValidation(best_model, best, _as_text(param_maps[best]), means, table)


def _depth_of(estimator: Estimator, param_map: Mapping) -> int:
    return param_map.get(estimator.maxDepth, estimator.getMaxDepth())


def _by_depth(estimator: Estimator, param_maps: Sequence[Mapping], evaluator: Evaluator) -> list[list[int]]:
    """Points that one fit serves, in the order of their depths: those of a classification tree that differ in depth
    alone, if the evaluator can count rows by weights; else each point is alone."""
    alone = [[p] for p in range(len(param_maps))]
    if not isinstance(estimator, DecisionTreeClassifier) or not evaluator.hasParam("weightCol") or evaluator.isSet("weightCol"):
        return alone
    if estimator.isDefined("thresholds") or estimator.isDefined("weightCol"):
        return alone
    groups: dict[tuple, list[int]] = {}
    for p, param_map in enumerate(param_maps):
        rest = tuple(sorted((param.name, repr(v)) for param, v in param_map.items() if param.name != "maxDepth"))
        groups.setdefault(rest, []).append(p)
    return [sorted(points, key=lambda p: _depth_of(estimator, param_maps[p])) for points in groups.values()]


def grid_search(
    estimator: Estimator, values: Mapping[str, Sequence], df: DataFrame, key: str | Sequence[str], **options
) -> CrossValidation:
    """Grid plus cross-validation with folds of equal class shares."""
    return cross_validate(estimator, grid(estimator, values), df, key, **{"stratify": "label", **options})


# ---- sampled search ----------------------------------------------------------------------------


@dataclass(frozen=True)
class QuantUniform:
    """Uniform between the limits, rounded to a multiple of ``step``."""

    low: float
    high: float
    step: float = 1.0

    def draw(self, u: Column) -> Column:
        value = F.lit(self.low) + u * F.lit(self.high - self.low)
        return F.bround(value / F.lit(self.step)) * F.lit(self.step)


@dataclass(frozen=True)
class LogUniform:
    """e to a power that is uniform between the limits."""

    low: float
    high: float

    def draw(self, u: Column) -> Column:
        return F.exp(F.lit(self.low) + u * F.lit(self.high - self.low))


def draw_space(spark: SparkSession, space: Mapping[str, QuantUniform | LogUniform], n: int, seed: int = 0) -> DataFrame:
    """``trial, params map<string,double>``; the same seed always gives the same draws."""

    def uniform(name: str) -> Column:
        digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("trial").cast("string"), F.lit(name)))
        return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))

    drawn = [x for name, prior in space.items() for x in (F.lit(name), prior.draw(uniform(name)).cast("double"))]
    return spark.range(n).select(F.col("id").cast("int").alias("trial"), F.create_map(*drawn).alias("params"))


@dataclass(frozen=True)
class Search:
    """``table``: ``trial, params, auc, loss`` for every trial."""

    best_model: Model
    best_params: dict[str, float]
    best_auc: float
    table: DataFrame


def sampled_search(
    make_estimator: Callable[..., Estimator],
    space: Mapping[str, QuantUniform | LogUniform],
    train: DataFrame,
    test: DataFrame,
    max_evals: int = 32,
    parallelism: int = 2,
    seed: int = 0,
    runs_root: str | None = None,
    parent_run_id: str | None = None,
    fit_partitions: int | None = None,
) -> Search:
    """Fit one model per drawn parameter set and keep the one with the highest exact test AUC.

    Boosted trees whose drawn parameters differ in ``n_estimators`` alone share the fit with the most trees, which is
    scored after each of their numbers of trees; the best one is fitted anew if it has fewer. With ``runs_root`` each
    trial is fitted and written to the run table, under the parent run. The driver holds the best model so far, no others;
    the shared folder is set for checkpoints, which cut the lineage of long fits.
    """
    spark = train.sparkSession
    shared_dir(spark)
    drawn = [(r["trial"], dict(r["params"])) for r in draw_space(spark, space, max_evals, seed).collect()]

    def whole(params: dict[str, float]) -> dict:
        return {n: int(v) if isinstance(space[n], QuantUniform) and v == int(v) else v for n, v in params.items()}

    held: dict[int, tuple[float, Model | None]] = {}
    lock = Lock()

    def hold(number: int, auc: float, model: Model | None) -> tuple[int, float]:
        with lock:
            held[number] = auc, model
            best = max(held, key=lambda i: (held[i][0], -i))
            for other in held.keys() - {best}:
                del held[other]
        return number, auc

    shared: dict = {}
    for number, params in drawn:
        staged = runs_root is None and "n_estimators" in params and isinstance(make_estimator(**whole(params)), GBTClassifier)
        rest = tuple(sorted((n, v) for n, v in params.items() if n != "n_estimators")) if staged else number
        shared.setdefault(rest, []).append((number, params))
    with (
        persisted(train.select("label", "features")) as kept_train,
        persisted(test.select("label", "features")) as kept_test,
    ):
        fit_rows, test_rows = (_tasks(t, fit_partitions) for t in (kept_train, kept_test))

        def trial(some: list[tuple[int, dict]]) -> Callable:
            def run() -> list[tuple[int, float]]:
                number, params = max(some, key=lambda t: t[1].get("n_estimators", 0))
                model = make_estimator(**whole(params)).fit(fit_rows)
                if len(some) > 1:
                    sizes = [int(p["n_estimators"]) for _, p in some]
                    areas = {r["n_trees"]: r["roc_auc"] for r in trees.staged_auc(model, test_rows, sizes).collect()}
                    most = int(params["n_estimators"])
                    return [hold(i, areas[n], model if n == most else None) for (i, _), n in zip(some, sizes)]
                auc = evaluate_binary(model.transform(test_rows), score="probability", num_bins=0)
                if runs_root is not None:
                    log_run(
                        spark, runs_root, run_name=f"trial {number}", run_id=new_run_id(), model=model,
                        params={n: str(v) for n, v in whole(params).items()},
                        metrics={"test_auc": auc}, parent_run_id=parent_run_id,
                    )
                return [hold(number, auc, model)]

            return run

        done = [t for part in _in_threads(spark, [trial(some) for some in shared.values()], parallelism) for t in part]
        areas = dict(sorted(done))
        best = max(areas, key=lambda i: (areas[i], -i))
        best_params, best_auc, best_model = dict(drawn)[best], areas[best], held.get(best, (0.0, None))[1]
        if best_model is None:
            best_model = make_estimator(**whole(best_params)).fit(fit_rows)
    rows = [(n, dict(drawn)[n], float(auc), -float(auc)) for n, auc in areas.items()]
    table = spark.createDataFrame(rows, "trial int, params map<string,double>, auc double, loss double")
    return Search(best_model, best_params, best_auc, table)
