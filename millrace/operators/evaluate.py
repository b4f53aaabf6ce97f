"""Classification metrics, ROC and AUC from prediction tables.

Class metrics start from one count per (label, prediction); curve metrics from one count per
distinct score. Both counts are combined before the shuffle, so a hot class or score is no burden.

In accuracy, F1 and the report a NULL prediction is a wrong answer and no class of its own. Rows without a
label are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import quoted
from millrace.operators.rank import ROWS_PER_TASK, running_totals

MACRO, WEIGHTED, ACCURACY = "macro avg", "weighted avg", "accuracy"


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``label, prediction, n``"""
    pair = [quoted(label).alias("label"), quoted(prediction).alias("prediction")]
    return pred.groupBy(*pair).agg(F.count(F.lit(1)).alias("n"))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(a / F.nullif(b, F.lit(0.0)), F.lit(0.0))


def per_class(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``class, precision, recall, f1, support, hits`` for every class seen as label or prediction.

    A ratio with nothing to divide by is 0.
    """
    counts = confusion_matrix(pred, label, prediction).filter(F.col("label").isNotNull())
    seen = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.col("n").alias("support"),
            F.lit(0).cast("long").alias("predicted"),
            F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            F.lit(0).cast("long").alias("support"),
            F.col("n").alias("predicted"),
            F.lit(0).cast("long").alias("hits"),
        ),
    )
    sums = (
        counts.select(F.explode(seen).alias("s"))
        .select("s.*")
        .filter(F.col("class").isNotNull())
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    hits, support, predicted = (F.col(c).cast("double") for c in ("hits", "support", "predicted"))
    return sums.select(
        "class",
        _ratio(hits, predicted).alias("precision"),
        _ratio(hits, support).alias("recall"),
        _ratio(2 * hits, support + predicted).alias("f1"),
        "support",
        "hits",
    )


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``name, precision, recall, f1, support``: a row per class, then accuracy and the averages.

    In the accuracy row only ``f1`` is set; it holds the accuracy, as printed reports show it.
    Everything follows from the one confusion count, without a second scan.
    """
    classes = per_class(pred, label, prediction)
    names = F.array(F.col("class").cast("string"), *[F.lit(n) for n in (ACCURACY, MACRO, WEIGHTED)])
    spread = classes.withColumn("name", F.explode(names)).withColumn("_weight", F.col("support").cast("double"))
    is_accuracy, is_weighted = F.col("name") == ACCURACY, F.col("name") == WEIGHTED

    def average(c: str) -> Column:
        weighted = _ratio(F.sum(F.col(c) * F.col("_weight")), F.sum("_weight"))
        return F.when(is_weighted, weighted).otherwise(F.avg(c))

    accuracy = _ratio(F.sum("hits").cast("double"), F.sum("_weight"))
    return spread.groupBy("name").agg(
        F.when(~is_accuracy, average("precision")).alias("precision"),
        F.when(~is_accuracy, average("recall")).alias("recall"),
        F.when(is_accuracy, accuracy).otherwise(average("f1")).alias("f1"),
        F.sum("support").alias("support"),
    )


def report_lines(report: DataFrame, digits: int = 2) -> DataFrame:
    """The report as text, one line per row: ``position, line``."""
    last = {ACCURACY: 1, MACRO: 2, WEIGHTED: 3}
    position = F.lit(0)
    for name, at in last.items():
        position = F.when(F.col("name") == name, F.lit(at)).otherwise(position)

    def number(c: str) -> Column:
        shown = F.when(F.col(c).isNotNull(), F.format_string(f"%.{digits}f", F.col(c))).otherwise("")
        return F.lpad(shown, 10, " ")

    line = F.concat(
        F.lpad("name", 14, " "),
        *[number(c) for c in ("precision", "recall", "f1")],
        F.lpad(F.col("support").cast("string"), 10, " "),
    )
    return report.select(position.alias("position"), "name", line.alias("line")).orderBy("position", "name")


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    same = quoted(label).eqNullSafe(quoted(prediction)).cast("int")
    return pred.filter(quoted(label).isNotNull()).agg(F.avg(same).alias("accuracy"))


def f1_weighted(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Support-weighted F1. A prediction outside the labels counts as wrong and weighs nothing."""
    weight = F.col("support").cast("double")
    f1 = _ratio(F.sum(F.col("f1") * weight), F.sum(weight))
    return per_class(pred, label, prediction).agg(f1.alias("f1"))


def class_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``accuracy, f1`` in one row from one confusion count."""
    weight = F.col("support").cast("double")
    return per_class(pred, label, prediction).agg(
        _ratio(F.sum("hits").cast("double"), F.sum(weight)).alias("accuracy"),
        _ratio(F.sum(F.col("f1") * weight), F.sum(weight)).alias("f1"),
    )


def mse(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.agg(F.avg(F.pow(quoted(label) - quoted(prediction), 2)).alias("mse"))


# ---- curves ------------------------------------------------------------------------------------


def _score_totals(pred: DataFrame, score: str, label: str, rows_per_task: int, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score with running totals from the highest score down. ``pred`` is computed once, here."""
    positive = quoted(label).cast("double") == 1.0
    rows = pred.select(*[quoted(b) for b in by], quoted(score).cast("double").alias("score"), positive.alias("p"))
    rows = rows.filter(F.col("score").isNotNull() & F.col("p").isNotNull())
    keys = [*[quoted(b) for b in by], F.col("score")]
    counts = rows.groupBy(*keys).agg(F.count_if(F.col("p")).alias("tp"), F.count_if(~F.col("p")).alias("fp"))
    return running_totals(counts, "score", ["tp", "fp"], descending=True, rows_per_task=rows_per_task, by=by)


def roc_curve(
    pred: DataFrame,
    score: str = "score",
    label: str = "label",
    drop_collinear: bool = True,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``fpr, tpr, threshold`` with a row per distinct score and a first point (0, 0, Infinity).

    ``drop_collinear`` leaves out inner points that lie evenly between their neighbours: those
    whose next score adds the same counts. The first and the last score always stay. No task puts more than
    ``rows_per_task`` scores in order.
    """
    totals = _score_totals(pred, score, label, rows_per_task)
    if drop_collinear:
        is_first = (F.col("cum_tp") == F.col("tp")) & (F.col("cum_fp") == F.col("fp"))
        is_last = F.col("next_tp").isNull()
        bends = (F.col("next_tp") != F.col("tp")) | (F.col("next_fp") != F.col("fp"))
        totals = totals.filter(is_first | is_last | bends)
    nan = F.lit(float("nan"))
    points = totals.select(
        F.coalesce(F.col("cum_fp") / F.nullif("total_fp", F.lit(0)), nan).alias("fpr"),
        F.coalesce(F.col("cum_tp") / F.nullif("total_tp", F.lit(0)), nan).alias("tpr"),
        F.col("score").alias("threshold"),
    )
    start = pred.sparkSession.createDataFrame([(0.0, 0.0, float("inf"))], points.schema)
    return start.unionByName(points)


def roc_auc(
    pred: DataFrame, score: str = "score", label: str = "label", rows_per_task: int = ROWS_PER_TASK, by: Sequence[str] = ()
) -> DataFrame:
    """``*by, roc_auc``: exact area under the ROC curve (tied scores count half); NULL with a single class."""
    totals = _score_totals(pred, score, label, rows_per_task, by)
    share = (
        (F.col("fp") / F.nullif("total_fp", F.lit(0)))
        * (F.col("cum_tp") - F.col("tp") / 2)
        / F.nullif("total_tp", F.lit(0))
    )
    area = F.sum(share).alias("roc_auc")
    return totals.groupBy(*[quoted(b) for b in by]).agg(area) if by else totals.agg(area)


def evaluate_binary(
    pred: DataFrame,
    metric: str = "areaUnderROC",
    score: str = "rawPrediction",
    label: str = "label",
    num_bins: int = 1000,
) -> float:
    """Spark's evaluator. It thins the curve to ``num_bins`` points; 0 keeps every score."""
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=score, labelCol=label, metricName=metric, numBins=num_bins
    )
    return evaluator.evaluate(pred)
