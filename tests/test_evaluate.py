"""Metrics against brute force and Spark's evaluators."""

import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from millrace.operators import evaluate


def scores(spark, pairs):
    return spark.createDataFrame([(float(s), int(y)) for s, y in pairs], "score double, label int")


def brute_auc(pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def brute_roc(pairs, drop):
    """Running counts per score, highest first; inner points with two equal steps are dropped."""
    steps = []
    for s in sorted({s for s, _ in pairs}, reverse=True):
        tp = sum(1 for t, y in pairs if t == s and y)
        fp = sum(1 for t, y in pairs if t == s and not y)
        steps.append((s, tp, fp))
    pos, neg = sum(t for _, t, _ in steps), sum(f for _, _, f in steps)
    points, tp, fp = [(0.0, 0.0, float("inf"))], 0, 0
    for i, (s, t, f) in enumerate(steps):
        tp, fp = tp + t, fp + f
        inner = 0 < i < len(steps) - 1
        if drop and inner and steps[i + 1][1:] == (t, f):
            continue
        points.append((fp / neg, tp / pos, s))
    return points


random.seed(4)
CASES = {
    "perfect": [(1, 1), (0.9, 1), (0.2, 0), (0.1, 0)],
    "inverted": [(0.1, 1), (0.2, 1), (0.8, 0), (0.9, 0)],
    "ties": [(0.5, i % 2) for i in range(10)] + [(0.7, 1), (0.7, 0), (0.1, 0)],
    "many": [(round(random.gauss(y, 1.5), 3), y) for y in (0, 1) for _ in range(700)],
    "distinct": [(random.random(), random.randint(0, 1)) for _ in range(1500)],
    "hot score": [(0.5, i % 3 == 0) for i in range(900)] + [(i / 100, i % 2) for i in range(100)],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("rows_per_task", [1, 20, 1_000_000])
def test_auc(spark, name, rows_per_task):
    df = scores(spark, CASES[name]).repartition(3)
    assert evaluate.roc_auc(df, rows_per_task=rows_per_task).first()[0] == pytest.approx(brute_auc(CASES[name]), abs=1e-12)


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("drop", [True, False])
def test_roc_curve(spark, name, drop):
    df = evaluate.roc_curve(scores(spark, CASES[name]), drop_collinear=drop, rows_per_task=5)
    found = sorted((-r["threshold"], r["fpr"], r["tpr"]) for r in df.collect())
    wanted = sorted((-t, f, p) for f, p, t in brute_roc(CASES[name], drop))
    assert found == [pytest.approx(w) for w in wanted]


def test_auc_is_sparks_without_thinning(spark):
    df = scores(spark, CASES["many"])
    vector = array_to_vector(F.array(-F.col("score"), F.col("score")))
    pred = df.select(vector.alias("rawPrediction"), F.col("label").cast("double").alias("label"))
    exact = evaluate.evaluate_binary(pred, num_bins=0)
    assert evaluate.roc_auc(df).first()[0] == pytest.approx(exact, abs=1e-12)
    assert 0 < evaluate.evaluate_binary(pred, "areaUnderPR") < 1


def test_one_class_has_no_auc(spark):
    df = scores(spark, [(0.1, 1), (0.4, 1)])
    assert evaluate.roc_auc(df).first()[0] is None
    points = evaluate.roc_curve(df).filter("threshold < 1").collect()
    assert all(p["fpr"] != p["fpr"] for p in points)  # NaN


# A class never predicted (3), a prediction that is no class (-1), a class absent from the truth (4).
MULTI = [(0, 0), (0, 0), (0, 1), (1, 1), (1, -1), (2, 2), (2, 0), (3, 2), (1, 4), (2, 2)]


def brute_report(pairs):
    out = {}
    for c in sorted({x for p in pairs for x in p}):
        hits = sum(y == c == p for y, p in pairs)
        support, predicted = sum(y == c for y, _ in pairs), sum(p == c for _, p in pairs)
        precision = hits / predicted if predicted else 0.0
        recall = hits / support if support else 0.0
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        out[str(c)] = (precision, recall, f1, support)
    n = len(pairs)
    rows = list(out.values())
    out["macro avg"] = tuple(sum(r[i] for r in rows) / len(rows) for i in range(3)) + (n,)
    out["weighted avg"] = tuple(sum(r[i] * r[3] for r in rows) / n for i in range(3)) + (n,)
    out["accuracy"] = (None, None, sum(y == p for y, p in pairs) / n, n)
    return out


def test_classification_report(spark):
    pred = spark.createDataFrame(MULTI, "label int, prediction int")
    found = {r["name"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in
             evaluate.classification_report(pred).collect()}
    wanted = brute_report(MULTI)
    assert found.keys() == wanted.keys()
    for name in wanted:
        assert found[name] == pytest.approx(wanted[name])
    lines = [r["line"] for r in evaluate.report_lines(evaluate.classification_report(pred)).collect()]
    assert len(lines) == 9 and lines[-1].split() == ["weighted", "avg", *(f"{x:.2f}" for x in wanted["weighted avg"][:3]), "10"]


def test_f1_and_accuracy(spark):
    pred = spark.createDataFrame(MULTI, "label int, prediction int")
    wanted = brute_report(MULTI)
    assert evaluate.f1_weighted(pred).first()[0] == pytest.approx(wanted["weighted avg"][2])
    assert evaluate.accuracy(pred).first()[0] == pytest.approx(wanted["accuracy"][2])
    assert tuple(evaluate.class_metrics(pred).first()) == pytest.approx((wanted["accuracy"][2], wanted["weighted avg"][2]))
    doubles = pred.filter("prediction >= 0").selectExpr("cast(label as double) label", "cast(prediction as double) prediction")
    spark_f1 = MulticlassClassificationEvaluator(metricName="f1").evaluate(doubles)
    assert evaluate.f1_weighted(doubles).first()[0] == pytest.approx(spark_f1)


def test_confusion_and_mse(spark):
    pred = spark.createDataFrame([(1.0, 3.0), (2.0, 2.0), (2.0, 2.0)], "label double, prediction double")
    assert {tuple(r) for r in evaluate.confusion_matrix(pred).collect()} == {(1.0, 3.0, 1), (2.0, 2.0, 2)}
    assert evaluate.mse(pred).first()[0] == pytest.approx(4 / 3)


def test_missing_predictions_are_wrong_answers(spark):
    rows = [(1.0, 1.0), (0.0, 0.0), (1.0, None), (0.0, 1.0), (None, 1.0)]
    pred = spark.createDataFrame(rows, "`the.label` double, prediction double")
    assert evaluate.accuracy(pred, "the.label").first()["accuracy"] == 0.5
    metrics = evaluate.class_metrics(pred, "the.label").first()
    assert metrics["accuracy"] == 0.5
    assert metrics["f1"] == evaluate.f1_weighted(pred, "the.label").first()["f1"]
    report = {r["name"]: r for r in evaluate.classification_report(pred, "the.label").collect()}
    assert set(report) == {"0.0", "1.0", "accuracy", "macro avg", "weighted avg"}
    assert report["accuracy"]["f1"] == 0.5 and abs(report["macro avg"]["recall"] - 0.5) < 1e-9


def test_names_with_dots(spark):
    pred = spark.createDataFrame([(1.0, 0.9, 2.0), (0.0, 0.1, 0.0), (0.0, 0.4, 1.0)], "`a.label` double, `a.score` double, `a.guess` double")
    assert evaluate.roc_auc(pred, "a.score", "a.label").first()[0] == 1.0
    assert evaluate.roc_curve(pred, "a.score", "a.label", drop_collinear=False).count() == 4
    assert evaluate.mse(pred, "a.label", "a.guess").first()[0] == pytest.approx(2 / 3)
