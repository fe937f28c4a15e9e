"""Classifier measures from counts: confusion measures, ROC points and area under the curve."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lossloom.operators.ordering import running_totals


def binary_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row of confusion counts and the measures derived from them; undefined ratios are null."""
    a, p = F.col(actual), F.col(predicted)
    counts = df.agg(
        F.count_if((a == 1) & (p == 1)).alias("tp"), F.count_if((a == 0) & (p == 0)).alias("tn"),
        F.count_if((a == 0) & (p == 1)).alias("fp"), F.count_if((a == 1) & (p == 0)).alias("fn"))
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn"))
    total = tp + tn + fp + fn
    recall, specificity = F.try_divide(tp, tp + fn), F.try_divide(tn, tn + fp)
    return counts.select(
        "tp", "tn", "fp", "fn",
        specificity.alias("accuracy_0"), recall.alias("accuracy_1"),
        F.try_divide(tp + tn, total).alias("accuracy"),
        F.greatest(F.try_divide(tp + fn, total), F.try_divide(tn + fp, total)).alias("null_accuracy"),
        F.try_divide(fp + fn, total).alias("misclassification"),
        recall.alias("sensitivity"), specificity.alias("specificity"),
        (1 - specificity).alias("false_positive_rate"), F.try_divide(fn, fn + tp).alias("false_negative_rate"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
        F.try_divide(tp, tp + fp).alias("precision"), F.try_divide(tn, tn + fn).alias("precision_0"),
        ((recall + specificity) / 2).alias("auc"))


def score_counts(df: DataFrame, score: str, actual: str) -> DataFrame:
    """Positives and negatives per distinct score, combined before the shuffle."""
    return df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(actual) == 1).alias("pos"), F.count_if(F.col(actual) == 0).alias("neg"))


def _cumulative(df: DataFrame, score: str, actual: str, places: int | None) -> DataFrame:
    """Distinct scores with positives and negatives at or above each.

    Rounded probabilities have at most 10 ** places + 1 values, which one window can hold; unrounded scores go
    through the distributed running totals.
    """
    if places is not None and places <= 6:
        counts = score_counts(df.withColumn("__s", F.round(score, places)), "__s", actual)
        w = Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
        return counts.withColumns({"tp": F.sum("pos").over(w), "fp": F.sum("neg").over(w)})
    return running_totals(score_counts(df, score, actual), [F.col("score").desc()], {"tp": F.col("pos"), "fp": F.col("neg")})


def roc_points(df: DataFrame, score: str, actual: str, places: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score."""
    totals = df.agg(F.count_if(F.col(actual) == 1).alias("p"), F.count_if(F.col(actual) == 0).alias("n")).first()
    return _cumulative(df, score, actual, places).select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp").cast("double"), F.lit(float(totals["n"]))).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.lit(float(totals["p"]))).alias("tpr"))


def auc(df: DataFrame, score: str, actual: str, places: int | None = None) -> DataFrame:
    """One row: probability that a positive scores above a negative, ties counting one half."""
    above = _cumulative(df, score, actual, places)
    wins = F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") + F.col("pos") / 2))
    return above.agg(F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"))
