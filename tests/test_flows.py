"""Whole flows from files to reports, on files written from the given tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import functions as fn
from millrace.operators import chat, clean, evaluate, features, infer, models, profile, runs, split, tune
from millrace.session import scratch_path
from millrace.sources import class_names, read_csv, read_image_folder, register, sql, table


@pytest.fixture(scope="module")
def credit_file(spark, sf):
    """Headerless file with ``?`` for unknown values, +/- as label that follows the price."""
    orders = table(spark, sf, "orders")
    unknown = F.col("o_orderkey") % 11 == 0
    label = F.when((F.col("o_totalprice") > 250000) != (F.col("o_orderkey") % 10 == 3), "+").otherwise("-")
    path = scratch_path(spark, "credit")
    orders.select(
        "o_orderkey",
        F.when(unknown, "?").otherwise(F.col("o_totalprice").cast("string")),
        F.when(F.col("o_orderkey") % 13 == 0, "?").otherwise(F.col("o_orderstatus")),
        "o_orderpriority",
        label,
    ).write.csv(path)
    return path


def test_credit_flow(spark, credit_file):
    raw = clean.rename_all(read_csv(spark, credit_file, infer=True), ["id", "amount", "status", "priority", "approved"])
    assert dict(raw.dtypes)["amount"] == "string"
    marked = clean.null_sentinels(raw, "?")
    share = profile.incomplete_fraction(marked).first()[0]
    whole = clean.drop_incomplete(marked)
    assert whole.count() == round((1 - share) * raw.count())
    typed = clean.cast_columns(whole, {"amount": "double"})
    mapped = clean.map_values(typed, "approved", {"+": 1.0, "-": 0.0}).withColumnRenamed("approved", "label")
    kept = clean.drop_outliers(mapped, "amount")
    wide = features.dummies(kept)
    x = [c for c in wide.columns if c not in ("id", "label")]
    assert len(x) == 1 + 3 + 5
    data = features.assemble(x).transform(wide)
    parts = split.split_exact(data, "id", train=0.8, seed=1)
    train, test = parts.filter("split = 'train'"), parts.filter("split = 'test'")
    model = models.fit_logistic(train, C=1.0, max_iter=100)
    pred = models.predict(model, test).withColumn("score", fn.positive_score())
    report = evaluate.classification_report(pred)
    assert evaluate.accuracy(pred).first()[0] > 0.8
    assert evaluate.roc_auc(pred).first()[0] > 0.8

    found = tune.grid_search(
        models.tree(), {"max_depth": [1, 4], "min_samples_leaf": [1, 10]}, data, "id", k=3, seed=1
    )
    assert found.table.count() == 12

    root = scratch_path(spark, "tracking")
    run = runs.log_run(spark, root, model=model, metrics=runs.report_metrics(report))
    assert runs.register_model(spark, root, "approval", run) == 1
    again = runs.load_registered(spark, root, "approval")
    assert models.predict(again, test).select("id", "prediction").exceptAll(pred.select("id", "prediction")).count() == 0


def test_census_flow(spark, sf):
    path = scratch_path(spark, "census")
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus"]
    income = F.when(F.col("l_quantity") > 25, " >50K").otherwise(" <=50K")
    lines = table(spark, sf, "lineitem").select(*columns, income.alias("income"))
    lines.write.options(ignoreLeadingWhiteSpace=False).csv(path)
    dataset = read_csv(spark, path, schema=lines.schema)
    pipeline = features.feature_pipeline(["l_returnflag", "l_linestatus"], columns[:3], "income")
    fitted = pipeline.fit(dataset)
    prepared = fitted.transform(dataset).select("label", "features", *dataset.columns)
    train, test = split.split_random(prepared, [0.7, 0.3], seed=100)
    assert train.count() + test.count() == 6000
    for fit, params in (
        (models.fit_logistic, {"maxIter": 10}),
        (models.fit_tree, {"maxDepth": 3}),
        (models.fit_forest, {"seed": 1}),
    ):
        pred = models.predict(fit(train, **params), test)
        assert evaluate.evaluate_binary(pred) > 0.95
        assert set(pred.select("label", "prediction", "probability", "l_quantity").columns)
    forest = models.forest(seed=1)
    points = tune.grid(forest, {"maxDepth": [2, 4], "numTrees": [2]})
    cv = tune.cross_validate(forest, points, train, [*columns, "income"], k=2, seed=1)
    final = models.predict(cv.best_model, prepared)
    register(final, "final_predictions")
    counted = sql(
        spark,
        "SELECT l_returnflag, prediction, count(*) AS count FROM final_predictions "
        "GROUP BY l_returnflag, prediction ORDER BY l_returnflag",
    ).collect()
    assert sum(r["count"] for r in counted) == 6000
    assert [r["l_returnflag"] for r in counted] == sorted(r["l_returnflag"] for r in counted)


def test_quality_flow(spark, sf):
    """Two header files with another separator, one table, boosted trees, search, best run."""
    parts_table = table(spark, sf, "part")
    paths = {}
    for name, keep in (("white", "p_partkey % 2 = 0"), ("red", "p_partkey % 2 = 1")):
        paths[name] = scratch_path(spark, name)
        quality = F.when(F.col("p_size") > 25, 8).otherwise(5).alias("quality")
        rows = parts_table.filter(keep).select("p_partkey", "p_size", "p_retailprice", quality)
        rows.write.options(header=True, sep=";").csv(paths[name])
    white, red = (read_csv(spark, paths[n], header=True, sep=";", cast_to="double") for n in ("white", "red"))
    both = clean.union_all(clean.with_literal(white, "is_red", 0.0), clean.with_literal(red, "is_red", 1.0))
    rows = clean.with_threshold_label(both, "quality", 7)
    rows = rows.withColumn("label", F.col("label").cast("double"))
    data = features.assemble(["p_size", "p_retailprice", "is_red"]).transform(rows)
    parts = split.split_exact(data, "p_partkey", test=0.2, seed=1)
    train, test = parts.filter("split = 'train'"), parts.filter("split = 'test'")
    assert test.count() == 40
    model = models.fit_gbt(train, n_estimators=3, random_state=0)
    pred = models.predict(model, test).withColumn("score", fn.positive_score())
    auc = evaluate.roc_auc(pred).first()[0]
    root = scratch_path(spark, "tracking")
    runs.log_run(spark, root, run_name="boosted", model=model, metrics={"test_auc": auc})
    search = runs.log_run(spark, root, run_name="search")
    space = {"n_estimators": tune.QuantUniform(2, 4), "learning_rate": tune.LogUniform(-3, 0)}
    tune.sampled_search(models.gbt, space, train, test, 2, 2, 1, runs_root=root, parent_run_id=search)
    best = runs.best_run(runs.runs_table(spark, root))
    assert best["metrics"]["test_auc"] >= auc > 0.9
    loaded = runs.load_run_model(spark, root, best["run_id"])
    assert models.predict(loaded, test.limit(5), ["prediction"]).count() == 5


def test_chat_flow(spark, sf):
    """Class folders, chat records, batched answers, parsing, metrics."""
    names = [f"{c}: kind {c.lower()}" for c in "ABCDEFGHIJ"]
    path = scratch_path(spark, "classes")
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("value"), "label")
    vectors.write.partitionBy("label").option("maxRecordsPerFile", 1).text(path)
    folders = class_names(spark, path, "*.txt")
    data = read_image_folder(spark, path, decode=False, pattern="*.txt", names=folders)
    data = data.withColumn("id", F.btrim(F.col("image").cast("string"), F.lit("\n")).cast("long")).drop("image")
    train = split.split_counts(data, "id", 300, 50, seed=42)
    assert {r["split"]: r["n"] for r in split.split_sizes(train).collect()} == {"train": 300, "validation": 50}
    prompt = fn.choice_prompt("Which kind?", names)
    records = chat.chat_messages(train, prompt, names)
    texts = records.select("id", chat.render_chat("messages").alias("text"))
    assert texts.filter(F.col("text").contains("Which kind?\nA: kind a")).count() == 350
    asked = chat.chat_messages(split.sample_n(data, "id", 100, seed=42), prompt, with_answer=False)

    def make_predict_fn():
        def answer(label):
            # right for even classes, an alternative spelling for those divisible by 4, else silent
            said = [
                f"I see ({names[i][0]}) {names[i][3:]}" if i % 4 == 0 else names[i] if i % 2 == 0 else "no idea"
                for i in label
            ]
            return np.array(said, dtype=object)

        return answer

    answered = infer.batch_infer(asked, ["label"], make_predict_fn, T.StringType(), output="generated_text")
    pred = answered.withColumn("prediction", fn.parse_response("generated_text", names))
    even = pred.filter("label % 2 = 0").count()
    metrics = evaluate.class_metrics(pred).first()
    assert metrics["accuracy"] == pytest.approx(even / 100) == metrics["f1"]
