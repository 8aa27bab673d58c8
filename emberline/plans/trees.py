"""Tree classifiers on prepared transactions (`features`, `label`)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.plans.metrics import accuracy, roc_auc


# Fixed values in the three models: impurity, depth, bins, numbers of trees and rounds, seed.
def random_forest() -> RandomForestClassifier:
    return RandomForestClassifier(impurity="gini", maxDepth=10, numTrees=10, featureSubsetStrategy="auto", seed=3000)


def boosted_trees() -> GBTClassifier:
    return GBTClassifier(maxIter=10, maxDepth=10, seed=3000)


def decision_tree() -> DecisionTreeClassifier:
    return DecisionTreeClassifier(impurity="entropy", maxDepth=10, maxBins=30, seed=3000)


@contextmanager
def held(df: DataFrame, *columns: str) -> Iterator[DataFrame]:
    """The columns of `df` in blocks on the executors' disks while they are read again and again, in the same partitions and order."""
    kept = df.select(*columns).persist(StorageLevel.DISK_ONLY)
    try:
        yield kept
    finally:
        kept.unpersist()


def fit_all(estimators: Sequence, train: DataFrame) -> list:
    """The fitted models. Each fit passes three times over the training rows, whose features are put together once."""
    with held(train, "features", "label") as rows:
        return [estimator.fit(rows) for estimator in estimators]


def predict(model, df: DataFrame) -> DataFrame:
    return model.transform(df)


def area_under_roc(predictions: DataFrame) -> float:
    """Exact, over every distinct score."""
    score = vector_to_array("rawPrediction")[1].alias("score")
    return roc_auc(predictions.select(score, F.col("label"))).first()["auc"]


def share_right(predictions: DataFrame) -> float:
    return accuracy(predictions, "label", "prediction").first()["accuracy"]


def model_summary(model) -> str:
    return model.toDebugString


def model_report(train: DataFrame, test: DataFrame) -> DataFrame:
    """Trains the three models and reports `(model, metric, value)`: one row for each."""
    forest, boosted, tree = fit_all([random_forest(), boosted_trees(), decision_tree()], train)
    with held(test, "features", "label") as unseen:
        rows = [
            ("random_forest", "area_under_roc", area_under_roc(predict(forest, unseen))),
            ("boosted_trees", "accuracy", share_right(predict(boosted, unseen))),
            ("decision_tree", "accuracy", share_right(predict(tree, unseen))),
        ]
    return train.sparkSession.createDataFrame(rows, "model string, metric string, value double")
