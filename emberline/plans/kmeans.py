"""One-dimensional k-means with an error-based stop."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.plans.snapshots import Snapshots

MAX_ROUNDS = 10
MIN_DROP = 0.01


def initial_centroids(points: DataFrame, k: int, init: str = "max_minus", column: str = "x") -> list[float]:
    """`max_minus`: max - 100 i; `even`: min + i * ((max - min) div k); for i = 1 .. k, without repeats."""
    low, high = points.agg(F.min(column), F.max(column)).first()
    if low is None:
        return []
    if init == "max_minus":
        found = [float(high) - 100.0 * i for i in range(1, k + 1)]
    elif init == "even":
        step = (int(high) - int(low)) // k
        found = [float(low) + float(step * i) for i in range(1, k + 1)]
    else:
        raise ValueError(f"unknown init {init!r}")
    return sorted(set(found))


def nearest(centroids: list[float], x: Column) -> Column:
    """The centroid closest to x; the lower one on a tie.

    The centroids are one array constant, so that every round runs the same compiled code.
    """
    gaps = F.transform(F.lit(centroids), lambda c: F.struct(F.abs(x - c).alias("gap"), c.alias("centroid")))
    return F.array_min(gaps)["centroid"]


def assign(points: DataFrame, centroids: list[float], column: str = "x") -> DataFrame:
    return points.withColumn("centroid", nearest(centroids, F.col(column)))


def step(points: DataFrame, centroids: list[float], column: str = "x", weight: str | None = None) -> DataFrame:
    """One round: per old centroid with points, the new one, the points, and the errors to the old one.

    `abs_error` is the rounded-down sum of absolute distances, `sse` the sum of squares.
    """
    n = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    away = F.abs(F.col(column) - F.col("centroid"))
    clusters = assign(points, centroids, column).groupBy(F.col("centroid").alias("old_centroid"))
    stats = clusters.agg(
        (F.sum(F.col(column) * n) / F.sum(n)).alias("centroid"),
        F.sum(n).alias("n"),
        F.floor(F.round(F.sum(away * n), 6)).alias("abs_error"),
        F.sum(away * away * n).alias("sse"),
    )
    return stats


def step_error(stats: DataFrame) -> DataFrame:
    """The error the stop rule reads: the sum over the clusters, as one row."""
    return stats.agg(F.coalesce(F.sum("abs_error"), F.lit(0).cast("bigint")).alias("abs_error"))


@dataclass
class Clustering:
    centroids: list[float]
    errors: list[int]
    """`abs_error` of each round run."""
    history: DataFrame
    """`(round, old_centroid, centroid, n, abs_error, sse)`, at most k rows per round."""


HISTORY = "round int, old_centroid double, centroid double, n bigint, abs_error bigint, sse double"


def kmeans_1d(
    points: DataFrame,
    k: int,
    init: str = "max_minus",
    column: str = "x",
    max_rounds: int = MAX_ROUNDS,
    snapshots: str | None = None,
    resume: bool = False,
) -> Clustering:
    """Rounds until the error drops by no more than 0.01, at most ten; the first always continues.

    Points with the same value always share a cluster, so the rounds run over the distinct values with
    their counts. Each round brings at most k rows to the driver. A cluster without points vanishes. With `snapshots`, the
    rows of round i are also written below that path as `iter=i`; with `resume` the run goes on behind the last round there.
    """
    spark = points.sparkSession
    store = None if snapshots is None else Snapshots(spark, snapshots, {"loop": "kmeans_1d", "k": k, "init": init})
    values = (
        points.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("x"))
        .agg(F.count(F.lit(1)).alias("weight"))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    rows: list[tuple] = []
    errors: list[int] = []
    try:
        if resume and store is not None and (last := store.last()):
            names = [c.split()[0] for c in HISTORY.split(", ")]
            rows = [tuple(r) for r in store.up_to(last[0]).select(*names).orderBy("round", "old_centroid").collect()]
            errors = last[1]["errors"]
            centroids = sorted({r[2] for r in rows if r[0] == last[0]})
        else:
            centroids = initial_centroids(values, k, init, "x")
        settled = len(errors) > 1 and errors[-2] - errors[-1] <= MIN_DROP
        while centroids and not settled and len(errors) < max_rounds:
            stats = sorted(step(values, centroids, "x", "weight").collect(), key=lambda r: r.old_centroid)
            number = len(errors) + 1
            rows += [(number, r.old_centroid, r.centroid, r.n, r.abs_error, r.sse) for r in stats]
            centroids = sorted({r.centroid for r in stats})
            errors.append(sum(r.abs_error for r in stats))
            if store is not None:
                store.write(number, spark.createDataFrame(rows[-len(stats):], HISTORY), errors=errors)
            settled = number > 1 and errors[-2] - errors[-1] <= MIN_DROP
    finally:
        values.unpersist()
    return Clustering(centroids, errors, spark.createDataFrame(rows, HISTORY))
