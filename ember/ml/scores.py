"""Model scores as grouped counts and sums.

Each is one aggregate over the predictions: the confusion counts have a row for
each pair of labels, the sums a single row, whatever the number of predictions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_counts(predictions: DataFrame, label: str = "index", prediction: str = "prediction") -> DataFrame:
    """``label, prediction, n`` of every pair that occurs."""
    return predictions.groupBy(F.col(label).cast("double").alias("label"),
                               F.col(prediction).cast("double").alias("prediction")).agg(F.count("*").alias("n"))


def label_scores(predictions: DataFrame, label: str = "index", prediction: str = "prediction") -> DataFrame:
    """``label, n, precision, recall, f1`` of every label that occurs as one; a
    label that is never predicted has precision 0."""
    counts = confusion_counts(predictions, label, prediction)
    # every count is a label's miss or hit, and a prediction's
    sides = counts.select(F.explode(F.array(
        F.struct(F.col("label").alias("label"), F.col("n").alias("n"), F.lit(0).cast("long").alias("told"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("prediction").alias("label"), F.lit(0).cast("long").alias("n"), F.col("n").alias("told"),
                 F.lit(0).cast("long").alias("hit")))).alias("s")).select("s.*")
    sums = sides.groupBy("label").agg(*(F.sum(c).alias(c) for c in ("n", "told", "hit"))).where("n > 0")
    hit = F.col("hit")
    return sums.select("label", "n", F.coalesce(F.try_divide(hit, "told"), F.lit(0.0)).alias("precision"),
                       (hit / F.col("n")).alias("recall"), (2 * hit / (F.col("n") + F.col("told"))).alias("f1"))


def weighted_f1(predictions: DataFrame, label: str = "index", prediction: str = "prediction") -> DataFrame:
    """One row ``score``: the labels' F1 weighted by their rows."""
    return label_scores(predictions, label, prediction).agg((F.sum(F.col("f1") * F.col("n")) / F.sum("n")).alias("score"))


def r2(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row ``score``: 1 - residual sum of squares / total sum of squares."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    residual = F.sum((y - p) * (y - p))
    return predictions.agg((1 - F.try_divide(residual, F.var_pop(y) * F.count(y))).alias("score"))
