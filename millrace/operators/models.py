"""Model fitting on ``label`` and ``features`` columns, scoring, and models as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.param import Params
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import positive_score
from millrace.session import scratch_path
from millrace.sources.tables import save_model

# Deepest tree Spark builds; stands for "no depth limit".
DEEPEST_TREE = 30

#: Seed of trees, forests and boosting unless told otherwise: a fit is the same in every process.
SEED = 0

# Parameter names of single-machine libraries and what Spark calls them.
COMMON_NAMES = {
    "criterion": "impurity",
    "learning_rate": "stepSize",
    "max_depth": "maxDepth",
    "max_iter": "maxIter",
    "min_samples_leaf": "minInstancesPerNode",
    "random_state": "seed",
}


def spark_params(params: Mapping, ensemble_size: str | None = None) -> dict:
    """Translate parameter names; anything without a counterpart is refused."""
    out = {}
    for name, value in params.items():
        if name == "min_samples_split":
            if value != 2:
                raise ValueError("min_samples_split has no counterpart; use min_samples_leaf")
            continue
        if name == "n_estimators":
            if ensemble_size is None:
                raise ValueError("n_estimators needs an ensemble")
            out[ensemble_size] = int(value)
            continue
        spark_name = COMMON_NAMES.get(name, name)
        if spark_name == "maxDepth":
            value = DEEPEST_TREE if value is None else int(value)
        out[spark_name] = value
    return out


def logistic(**params) -> LogisticRegression:
    return LogisticRegression(**spark_params(params))


def tree(**params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(**{"seed": SEED, **spark_params(params)})


def forest(**params) -> RandomForestClassifier:
    return RandomForestClassifier(**{"seed": SEED, **spark_params(params, "numTrees")})


def gbt(**params) -> GBTClassifier:
    """Boosted trees; 100 trees of depth 3 at rate 0.1 and seed 0 unless told otherwise.

    Boosting adds a step of lineage per tree. With a checkpoint folder set, Spark cuts it every
    ``checkpointInterval`` trees.
    """
    defaults = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 3, "seed": SEED}
    return GBTClassifier(**{**defaults, **spark_params(params, "maxIter")})


def forest_regressor(**params) -> RandomForestRegressor:
    return RandomForestRegressor(**{"seed": SEED, **spark_params(params, "numTrees")})


def fit_logistic(df: DataFrame, C: float | None = None, **params):
    """Logistic regression. ``C`` is the inverse penalty on the summed loss, on unscaled features;
    Spark's penalty is per row, hence the row count."""
    if C is not None:
        params = {"regParam": 1.0 / (C * df.count()), "standardization": False, **params}
    return logistic(**params).fit(df)


def fit_tree(df: DataFrame, **params):
    return tree(**params).fit(df)


def fit_forest(df: DataFrame, **params):
    return forest(**params).fit(df)


def fit_gbt(df: DataFrame, **params):
    return gbt(**params).fit(df)


def fit_forest_regressor(df: DataFrame, **params):
    return forest_regressor(**params).fit(df)


def predict(model: Model, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """Add prediction columns; ``keep`` narrows the result, which also narrows the scan."""
    out = model.transform(df)
    return out if keep is None else out.select(*keep)


def _last_stage(model: Model) -> Model:
    return model.stages[-1] if isinstance(model, PipelineModel) else model


def coefficients_table(model: Model, names: Sequence[str] | None = None) -> DataFrame:
    """``position, name, weight``; the intercept is row -1."""
    fitted = _last_stage(model)
    weights = [float(w) for w in fitted.coefficients]
    names = [f"f{i}" for i in range(len(weights))] if names is None else list(names)
    if len(names) != len(weights):
        raise ValueError(f"{len(weights)} weights but {len(names)} names")
    rows = [(-1, "(intercept)", float(fitted.intercept))]
    rows += [(i, n, w) for i, (n, w) in enumerate(zip(names, weights))]
    return SparkSession.active().createDataFrame(rows, "position int, name string, weight double")


def tree_summary(model: Model) -> DataFrame:
    """``tree, n_nodes, depth``: one row, or one per tree of an ensemble."""
    fitted = _last_stage(model)
    trees = getattr(fitted, "trees", [fitted])
    rows = [(i, int(t.numNodes), int(t.depth)) for i, t in enumerate(trees)]
    return SparkSession.active().createDataFrame(rows, "tree int, n_nodes int, depth int")


def node_rows(model: Model, path: str | None = None) -> DataFrame:
    """A tree model's own files (written to ``path`` if given): a row per node, with the number of its ``tree``."""
    spark = SparkSession.active()
    path = path or scratch_path(spark, "tree")
    save_model(_last_stage(model), path)
    nodes = spark.read.parquet(f"{path}/data")
    if "nodeData" in nodes.columns:
        return nodes.select(F.col("treeID").alias("tree"), "nodeData.*")
    return nodes.withColumn("tree", F.lit(0))


def tree_nodes(model: Model, path: str | None = None) -> DataFrame:
    """Node table of a tree model, read from the model's own files (written to ``path`` if given).

    ``n_categories`` is NULL where a node splits at a threshold; elsewhere the categories that go left are listed.
    """
    split = F.size("split.leftCategoriesOrThreshold") > 0
    return node_rows(model, path).select(
        "tree",
        F.col("id").alias("node"),
        "prediction",
        "impurity",
        "gain",
        F.nullif("leftChild", F.lit(-1)).alias("left_child"),
        F.nullif("rightChild", F.lit(-1)).alias("right_child"),
        F.nullif("split.featureIndex", F.lit(-1)).alias("feature"),
        F.when(split, F.col("split.leftCategoriesOrThreshold")).alias("left_categories_or_threshold"),
        F.nullif("split.numCategories", F.lit(-1)).alias("n_categories"),
    )


def fitted_vs_residuals(pred: DataFrame, label: str = "label", keep: Sequence[str] = ()) -> DataFrame:
    """Fitted probability of class 1 and what is left of the label, with any columns to keep."""
    fitted = positive_score("probability")
    return pred.select(*keep, fitted.alias("fitted"), (F.col(label) - fitted).alias("residual"))


def param_values(stage: Params) -> dict[str, str]:
    """Every parameter that has a value, as text."""
    if isinstance(stage, PipelineModel):
        return {
            f"{i}.{name}": value
            for i, s in enumerate(stage.stages)
            for name, value in param_values(s).items()
        }
    return {p.name: str(v) for p, v in stage.extractParamMap().items()}


def param_table(estimator: Estimator | Model) -> DataFrame:
    """``name, doc, default, current`` for every parameter."""

    def text(found: bool, value) -> str | None:
        return str(value()) if found else None

    rows = [
        (
            p.name,
            p.doc,
            text(estimator.hasDefault(p), lambda p=p: estimator._defaultParamMap[p]),
            text(estimator.isDefined(p), lambda p=p: estimator.getOrDefault(p)),
        )
        for p in estimator.params
    ]
    columns = "name string, doc string, `default` string, current string"
    return SparkSession.active().createDataFrame(rows, columns)
