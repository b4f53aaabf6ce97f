"""Fitting, scoring, model tables, tuning, run tables."""

import gc
import time
import weakref

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.functions import positive_score
from millrace.operators import evaluate, features, models, runs, split, trees, tune
from millrace.plans import tuning
from millrace.plans.modeling import prepared_groups
from millrace.session import scratch_path
from millrace.sources import load_model, save_model, table


@pytest.fixture(scope="module")
def planted(spark, sf):
    """Quantity after discount decides the label; every tenth row, by hash, is turned around."""
    lines = table(spark, sf, "lineitem")
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in lines.columns]))
    flip = F.conv(F.substring(digest, 1, 4), 16, 10).cast("int") % 10 == 0
    clean = F.col("l_quantity") * (1 - F.col("l_discount")) > 24
    rows = lines.withColumn("label", (clean != flip).cast("double")).withColumn("key", digest)
    pipeline = features.feature_pipeline(["l_returnflag"], ["l_quantity", "l_discount", "l_tax"])
    prepared = features.prepare(rows, pipeline, ["key"]).persist()
    parts = split.split_exact(prepared, "key", train=0.7, seed=1)
    yield prepared, parts.filter("split = 'train'"), parts.filter("split = 'test'")
    prepared.unpersist()


FITS = {
    "logistic": (models.fit_logistic, {"maxIter": 10}),
    "logistic penalty": (models.fit_logistic, {"C": 1.0, "max_iter": 100}),
    "tree": (models.fit_tree, {"max_depth": 3}),
    "stump": (models.fit_tree, {"max_depth": 1, "min_samples_leaf": 1}),
    "forest": (models.fit_forest, {"random_state": 1}),
    "boosted": (models.fit_gbt, {"n_estimators": 5}),
}


@pytest.mark.parametrize("name", FITS)
def test_learns_planted_signal(planted, name):
    _, train, test = planted
    fit, params = FITS[name]
    pred = models.predict(fit(train, **params), test).withColumn("score", positive_score())
    assert evaluate.roc_auc(pred).first()[0] > 0.8


def test_refused_parameters():
    with pytest.raises(ValueError, match="min_samples_split"):
        models.spark_params({"min_samples_split": 5})
    assert models.spark_params({"min_samples_split": 2, "max_depth": None}) == {"maxDepth": models.DEEPEST_TREE}
    with pytest.raises(ValueError, match="ensemble"):
        models.spark_params({"n_estimators": 5})


def test_coefficients_and_names(planted):
    prepared, train, _ = planted
    names = features.feature_names(prepared)
    assert names[-3:] == ["l_quantity", "l_discount", "l_tax"] and names[0].startswith("l_returnflagclassVec_")
    weights = {r["name"]: r["weight"] for r in models.coefficients_table(models.fit_logistic(train), names).collect()}
    assert weights["l_quantity"] > 0 > weights["l_discount"] and "(intercept)" in weights
    with pytest.raises(ValueError):
        models.coefficients_table(models.fit_logistic(train, maxIter=1), ["a"])


def test_tree_tables(planted):
    _, train, _ = planted
    model = models.fit_tree(train, max_depth=2)
    summary = models.tree_summary(model).first()
    nodes = models.tree_nodes(model).collect()
    assert summary["n_nodes"] == len(nodes) == model.numNodes and summary["depth"] == model.depth
    inner = [n for n in nodes if n["left_child"] is not None]
    assert all(n["feature"] is not None and n["left_categories_or_threshold"] for n in inner)
    assert len(inner) == (len(nodes) - 1) / 2
    forest = models.fit_forest(train, n_estimators=3, max_depth=2, random_state=1)
    counted = models.tree_nodes(forest).groupBy("tree").count().collect()
    assert {r["tree"]: r["count"] for r in counted} == {
        r["tree"]: r["n_nodes"] for r in models.tree_summary(forest).collect()
    }


def test_reload_and_param_table(planted, spark):
    prepared, train, test = planted
    model = models.fit_gbt(train, n_estimators=2)
    again = load_model(save_model(model, scratch_path(spark, "gbt")))
    assert type(again) is type(model)
    old, new = (models.predict(m, test, ["key", "prediction"]) for m in (model, again))
    assert old.exceptAll(new).count() == 0 and new.exceptAll(old).count() == 0
    current = {r["name"]: r["current"] for r in models.param_table(models.gbt()).collect()}
    assert (current["maxIter"], current["stepSize"], current["maxDepth"], current["seed"]) == ("100", "0.1", "3", "0")


def test_regressor(planted):
    prepared, _, _ = planted
    fitted = models.fit_forest_regressor(prepared, max_depth=2, random_state=42)
    assert evaluate.mse(models.predict(fitted, prepared)).first()[0] < 0.25


def test_unseen_category(spark):
    train = spark.createDataFrame([("a", 1.0, 0.0), ("b", 2.0, 1.0)], "c string, x double, label double")
    new = spark.createDataFrame([("z", 1.0, 0.0)], "c string, x double, label double")
    strict = features.feature_pipeline(["c"], ["x"]).fit(train)
    with pytest.raises(Exception, match="nseen label"):
        strict.transform(new).collect()
    lenient = features.feature_pipeline(["c"], ["x"], handle_invalid="keep").fit(train)
    assert lenient.transform(new).count() == 1


@pytest.mark.parametrize("rows_per_task", [3, 1_000_000])
def test_index_table(spark, rows_per_task):
    """A table of levels indexes as the fitted indexer does, over several ranges, ties and hot levels too."""
    rows = [(f"v{i % 40}" if i % 3 else "hot", i) for i in range(500)]
    df = spark.createDataFrame(rows, "`c.c` string, value int")
    levels = features.index_table(df, "c.c", rows_per_task)
    fitted = features.index_categories(["c"]).fit(df.select(F.col("`c.c`").alias("c")))
    assert [r["value"] for r in levels.orderBy("index").collect()] == list(fitted.labelsArray[0])
    assert levels.agg(F.sum("n")).first()[0] == 500
    found = features.with_index(df, "c.c", levels)
    assert found.columns == ["c.c", "value", "c.cIndex"] and found.count() == 500
    at = {v: float(i) for i, v in enumerate(fitted.labelsArray[0])}
    assert all(r["c.cIndex"] == at[r["c.c"]] for r in found.collect())
    odd = spark.createDataFrame([("hot", 1), ("new", 2), (None, 3)], "`c.c` string, value int")
    assert [r["c.cIndex"] for r in features.with_index(odd, "c.c", levels, handle_invalid="keep").orderBy("value").collect()] == [0.0, 41.0, 41.0]
    assert features.with_index(odd, "c.c", levels, handle_invalid="skip").count() == 1
    with pytest.raises(Exception, match="unknown category"):
        features.with_index(odd, "c.c", levels).collect()
    assert features.index_table(df.filter("false"), "c.c").count() == 0


def test_index_ties_by_name(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "c", "a", "c", "b", "a", "d"]], "v string")
    fitted = features.index_categories(["v"]).fit(df)
    assert list(fitted.labelsArray[0]) == ["a", "b", "c", "d"]


# ---- tuning ------------------------------------------------------------------------------------


def test_grid():
    estimator = models.tree()
    points = tune.grid(estimator, {"max_depth": [None, 1, 2, 3, 4], "min_samples_leaf": list(range(1, 11))})
    assert len(points) == 50
    with pytest.raises(ValueError, match="min_samples_split"):
        tune.grid(estimator, {"min_samples_split": [5, 7, 9, 10, 11]})


def test_cross_validate(planted):
    prepared, _, _ = planted
    estimator = models.tree()
    points = tune.grid(estimator, {"maxDepth": [0, 3], "maxBins": [20, 40]})
    cv = tune.cross_validate(estimator, points, prepared, "key", k=3, seed=2)
    assert cv.table.count() == 12
    assert cv.best_params["maxDepth"] == "3"
    assert 1 <= cv.best_model.depth <= 3  # Spark joins sister leaves of one class
    assert max(cv.mean_metrics) == cv.mean_metrics[cv.best_point] > 0.8
    again = tune.cross_validate(estimator, points, prepared, "key", k=3, seed=2, parallelism=1)
    assert again.mean_metrics == pytest.approx(cv.mean_metrics)


def test_smaller_is_better(spark, sf):
    prepared = prepared_groups(spark, sf)
    estimator = models.forest_regressor(n_estimators=2, random_state=1)
    from pyspark.ml.evaluation import RegressionEvaluator

    cv = tune.cross_validate(
        estimator, tune.grid(estimator, {"maxDepth": [0, 2]}), prepared, "o_orderkey", RegressionEvaluator(), k=2
    )
    assert cv.mean_metrics[cv.best_point] == min(cv.mean_metrics)


def test_grid_search_accuracy(planted):
    prepared, _, _ = planted
    found = tune.grid_search(
        models.tree(), {"max_depth": [1, 2]}, prepared, "key", k=2,
        evaluator=MulticlassClassificationEvaluator(metricName="accuracy"),
    )
    assert found.mean_metrics[found.best_point] > 0.85


def test_depths_share_a_fit(planted, monkeypatch):
    """Metrics of cut trees are those of trees fitted to each depth, and one fit serves all depths."""
    prepared, _, _ = planted
    estimator = models.tree()
    points = tune.grid(estimator, {"max_depth": [5, 0, 2, 3, 1], "min_samples_leaf": [1, 40]})
    fits = []
    fit = type(estimator).fit
    monkeypatch.setattr(type(estimator), "fit", lambda self, *a: fits.append(a) or fit(self, *a))
    for evaluator in (None, MulticlassClassificationEvaluator(metricName="accuracy")):
        fits.clear()
        shared = tune.cross_validate(estimator, points, prepared, "key", evaluator, k=2, seed=2)
        assert len(fits) == 2 * 2 + 1
        monkeypatch.setattr(tune, "_by_depth", lambda e, maps, _: [[p] for p in range(len(maps))])
        alone = tune.cross_validate(estimator, points, prepared, "key", evaluator, k=2, seed=2)
        monkeypatch.undo()
        monkeypatch.setattr(type(estimator), "fit", lambda self, *a: fits.append(a) or fit(self, *a))
        assert shared.mean_metrics == pytest.approx(alone.mean_metrics, abs=1e-12)
        assert shared.best_point == alone.best_point
        rows = lambda cv: [tuple(r) for r in cv.table.select("point", "fold", F.round("metric", 10)).collect()]
        assert rows(shared) == rows(alone)


def test_cut_trees_predict_as_fitted_ones(planted):
    _, train, test = planted
    deep = models.fit_tree(train, max_depth=7)
    found = trees.scored_at_depths(deep, test, [0, 1, 2, 4, 7])
    for depth, rows in found.items():
        own = models.predict(models.fit_tree(train, max_depth=depth), test)
        counts = own.groupBy("label", vector_to_array("rawPrediction").alias("raw"), "prediction").count().collect()
        cut = rows.select("label", vector_to_array("rawPrediction").alias("raw"), "prediction", "rows_").collect()
        of = lambda rows: sorted((r[0], list(r[1]), r[2], r[3]) for r in rows)
        merged = {}
        for label, raw, prediction, n in of(cut):
            merged[label, *raw, prediction] = merged.get((label, *raw, prediction), 0) + n
        assert merged == {(r[0], *r[1], r[2]): r[3] for r in of(counts)}


def test_staged_scores_are_those_of_smaller_fits(planted):
    _, train, test = planted
    model = models.fit_gbt(train, n_estimators=8, learning_rate=0.3)
    staged = {r["n_trees"]: r["roc_auc"] for r in trees.staged_auc(model, test, [8, 1, 3]).collect()}
    for n, auc in staged.items():
        pred = models.predict(models.fit_gbt(train, n_estimators=n, learning_rate=0.3), test).withColumn("score", positive_score())
        assert auc == pytest.approx(evaluate.roc_auc(pred).first()[0], abs=1e-12)
    assert sorted(staged) == [1, 3, 8]
    with pytest.raises(ValueError):
        trees.staged_auc(model, test, [9])


def test_search_shares_fits(planted, monkeypatch):
    _, train, test = planted
    space = {"n_estimators": tune.QuantUniform(1, 6), "max_depth": tune.QuantUniform(1, 2)}
    fits = []
    monkeypatch.setattr(tune.GBTClassifier, "fit", lambda self, *a, f=tune.GBTClassifier.fit: fits.append(a) or f(self, *a))
    found = tune.sampled_search(models.gbt, space, train, test, 9, 2, 5)
    assert len(fits) <= 3 and found.table.count() == 9
    for r in found.table.collect():
        if r["auc"] == found.best_auc or r["trial"] == 0:
            params = {n: int(v) for n, v in r["params"].items()}
            pred = models.predict(models.fit_gbt(train, **params), test).withColumn("score", positive_score())
            assert r["auc"] == pytest.approx(evaluate.roc_auc(pred).first()[0], abs=1e-12)
    assert len(found.best_model.trees) == int(found.best_params["n_estimators"])


def test_rows_walk_the_node_table(planted, spark):
    prepared, train, test = planted
    model = models.fit_tree(train, max_depth=6)
    nodes = models.tree_nodes(model)
    walked = trees.walk(test, nodes).join(nodes.select("node", F.col("prediction").alias("found")), "node")
    assert walked.count() == test.count()
    both = models.predict(model, walked)
    assert both.filter("found <> prediction").count() == 0
    # A feature of categories: the model knows them from the column's metadata.
    rows = spark.createDataFrame([("abcdef"[i % 6], float(i % 6 in (1, 4))) for i in range(60)], "c string, label double")
    indexed = features.index_categories(["c"]).fit(rows).transform(rows)
    ready = features.assemble([f for f in indexed.columns if f not in ("c", "label")]).transform(indexed)
    grouped = models.fit_tree(ready, max_depth=2)
    nodes = models.tree_nodes(grouped)
    assert nodes.filter("n_categories IS NOT NULL").count() > 0
    walked = trees.walk(ready, nodes).join(nodes.select("node", F.col("prediction").alias("found")), "node")
    assert walked.filter("found = label").count() == 60


SPACE = {"n_estimators": tune.QuantUniform(2, 4), "learning_rate": tune.LogUniform(-3, 0), "max_depth": tune.QuantUniform(1, 2)}


def test_draws(spark):
    drawn = [r["params"] for r in tune.draw_space(spark, SPACE, 200, seed=3).collect()]
    assert drawn == [r["params"] for r in tune.draw_space(spark, SPACE, 200, seed=3).collect()]
    assert {d["n_estimators"] for d in drawn} == {2.0, 3.0, 4.0}
    rates = [d["learning_rate"] for d in drawn]
    assert 0.049 < min(rates) < 0.07 and 0.8 < max(rates) <= 1.0


def test_sampled_search_with_runs(planted, spark):
    _, train, test = planted
    root = scratch_path(spark, "runs")
    parent = runs.log_run(spark, root, run_name="search")
    found = tune.sampled_search(models.gbt, SPACE, train, test, 3, 2, 5, runs_root=root, parent_run_id=parent)
    assert found.table.count() == 3
    assert found.best_auc == found.table.agg(F.max("auc")).first()[0]
    recorded = runs.runs_table(spark, root)
    assert runs.search_runs(recorded, parent_run_id=parent).count() == 3
    best = runs.best_run(recorded)
    assert best["metrics"]["test_auc"] == found.best_auc
    assert best["params"]["n_estimators"] == str(int(found.best_params["n_estimators"]))
    loaded = runs.load_run_model(spark, root, best["run_id"])
    pred = models.predict(loaded, test).withColumn("score", positive_score())
    assert evaluate.roc_auc(pred).first()[0] == pytest.approx(found.best_auc)


def test_registered_search_is_the_published_one(spark, sf, monkeypatch):
    """All 32 trials over the published ranges; here each asked-for model is recorded and a stump is fitted in its place."""
    asked = []

    def stump(**params):
        asked.append(params)
        return gbt(n_estimators=1, max_depth=1)

    gbt = models.gbt
    monkeypatch.setattr(models, "gbt", stump)
    found = tuning.sampled_search(spark, sf).collect()
    assert sorted(r["trial"] for r in found) == list(range(32))
    sizes = [r["n_estimators"] for r in found]
    assert 20 <= min(sizes) < 60 and 940 < max(sizes) <= 1000
    assert {r["max_depth"] for r in found} == {2.0, 3.0, 4.0, 5.0}
    assert 0.049 < min(r["learning_rate"] for r in found) < 0.1 < 0.7 < max(r["learning_rate"] for r in found) <= 1.0
    assert {p["n_estimators"] for p in asked} == {int(n) for n in sizes} and {p["max_depth"] for p in asked} == {2, 3, 4, 5}


def test_search_holds_the_best_model_only(planted, monkeypatch):
    _, train, test = planted
    alive, most = weakref.WeakSet(), []
    fit = tune.GBTClassifier.fit

    def counted(self, *args):
        model = fit(self, *args)
        alive.add(model)
        gc.collect()
        most.append(len(alive))
        return model

    monkeypatch.setattr(tune.GBTClassifier, "fit", counted)
    found = tune.sampled_search(models.gbt, SPACE, train, test, 6, 1, 5)
    assert len(most) == 6 and max(most) <= 3  # the best, the one just scored, and the one just fitted
    assert found.best_auc == found.table.agg(F.max("auc")).first()[0]
    pred = models.predict(found.best_model, test).withColumn("score", positive_score())
    assert evaluate.roc_auc(pred).first()[0] == pytest.approx(found.best_auc)


# ---- run and model tables ----------------------------------------------------------------------


def test_run_order_and_ties(spark):
    root = scratch_path(spark, "runs")
    old = runs.log_run(spark, root, run_name="old", metrics={"test_auc": 0.9})
    time.sleep(0.01)
    new = runs.log_run(spark, root, run_name="new", metrics={"test_auc": 0.9}, params={"a": 1})
    none = runs.log_run(spark, root, run_name="none")
    low = runs.log_run(spark, root, run_name="low", metrics={"test_auc": 0.2})
    recorded = runs.runs_table(spark, root)
    order = ["metrics.test_auc DESC", "start_time DESC"]
    assert [r["run_id"] for r in runs.search_runs(recorded, order).collect()] == [new, old, low, none]
    assert [r["run_id"] for r in runs.search_runs(recorded, order, 1).collect()] == [new]
    assert runs.get_run(spark, root, new)["params"] == {"a": "1"}
    with pytest.raises(KeyError):
        runs.get_run(spark, root, "missing")


def test_versions(planted, spark):
    prepared, train, _ = planted
    root = scratch_path(spark, "models")
    model = models.fit_tree(train, max_depth=1)
    pred = models.predict(model, prepared)
    shown = features.signature(prepared, pred.select("prediction"))
    run = runs.log_run(spark, root, model=model, params={"max_depth": 1}, signature=shown)
    assert [runs.register_model(spark, root, n, run) for n in ("a", "a", "b", "a")] == [1, 2, 1, 3]
    assert runs.load_registered(spark, root, "a").numNodes == model.numNodes
    assert runs.load_registered(spark, root, "a", 1).numNodes == model.numNodes
    assert runs.get_run(spark, root, run)["params"]["maxDepth"] == "1"
    assert '"outputs"' in runs.get_run(spark, root, run)["signature"]
    with pytest.raises(KeyError):
        runs.load_registered(spark, root, "c")
    empty = runs.log_run(spark, root)
    with pytest.raises(ValueError):
        runs.register_model(spark, root, "a", empty)


def test_two_writers_never_share_a_version(planted, spark):
    from multiprocessing.pool import ThreadPool

    _, train, _ = planted
    root = scratch_path(spark, "models")
    run = runs.log_run(spark, root, model=models.fit_tree(train, max_depth=1))
    with ThreadPool(6) as pool:
        versions = pool.map(lambda _: runs.register_model(spark, root, "name", run), range(12))
    assert sorted(versions) == list(range(1, 13))
    assert runs.models_table(spark, root).count() == 12
    assert not runs._claim(spark, f"{root}/claims/{runs._name_digest('name')}/3")


def test_concurrent_records(spark):
    """Runs recorded at the same time all arrive."""
    from multiprocessing.pool import ThreadPool

    root = scratch_path(spark, "runs")
    with ThreadPool(6) as pool:
        ids = pool.map(lambda i: runs.log_run(spark, root, metrics={"m": i}), range(12))
    assert {r["run_id"] for r in runs.runs_table(spark, root).collect()} == set(ids)
