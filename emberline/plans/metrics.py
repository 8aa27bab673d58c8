"""Evaluation of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.operators.ranges import running_totals


def confusion_matrix(results: DataFrame, actual: str = "actual", pred: str = "pred") -> DataFrame:
    """One row `(tp, fp, tn, fn)`. Predictions other than 0 and 1 do not count."""
    a, p = F.col(actual), F.col(pred)
    return results.agg(
        F.count_if((p == 1) & (a == 1)).alias("tp"),
        F.count_if((p == 1) & (a != 1)).alias("fp"),
        F.count_if((p == 0) & (a == 0)).alias("tn"),
        F.count_if((p == 0) & (a != 0)).alias("fn"),
    )


def accuracy(results: DataFrame, actual: str = "actual", pred: str = "pred") -> DataFrame:
    """Share of rows whose prediction is right; null without rows."""
    return results.agg(F.avg((F.col(actual) == F.col(pred)).cast("double")).alias("accuracy"))


def roc_auc(scores: DataFrame, score: str = "score", label: str = "label", rows_per_range: int | None = None) -> DataFrame:
    """Exact area under the ROC curve, as one row `(auc)`; null when a class is missing.

    Rows of one score are merged first. Each score's positives then meet the negatives below it, plus half
    of those at the same score; the running count goes through ranges.
    """
    positive = F.col(label) == 1
    merged = scores.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    ranked = running_totals(merged, "score", {"neg_below": F.col("neg")}, rows_per_range, unique=True)
    won = F.sum(F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return ranked.agg(F.when(pairs > 0, won / pairs).alias("auc"))
