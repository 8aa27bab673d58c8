"""Row-wise and set operators on tables, mostly edge tables `(src, dst)`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.operators.skew import ROWS_PER_TASK, balanced_join, hot_keys


def filter_max_id(edges: DataFrame, max_id: int) -> DataFrame:
    """Edges whose two ids are both below `max_id`."""
    return edges.where((F.col("src") < max_id) & (F.col("dst") < max_id))


def reverse_edges(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def weighted_edges(edges: DataFrame) -> DataFrame:
    """Distinct edges with their number of copies: `(src, dst, n)`."""
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def tagged_union(first: DataFrame, second: DataFrame, key: str, value: str, tags: tuple[str, str] = ("A", "B")) -> DataFrame:
    """Rows of two inputs as `(key, tag, value)`, tagged by the input they come from."""
    parts = [
        df.select(F.col(key).alias("key"), F.lit(tag).alias("tag"), F.col(value).cast("string").alias("value"))
        for df, tag in zip((first, second), tags, strict=True)
    ]
    return parts[0].unionByName(parts[1])


def explode_neighbours(edges: DataFrame, state: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """One relaxation step: `(dst, dist + 1)` for each edge out of a vertex of `state (v, dist)`, and the vertex itself."""
    known = state.select(F.col("v").alias("src"), "dist")
    hot = hot_keys(edges, ["src"], rows_per_task)
    moved = balanced_join(edges, known, ["src"], ["dst"], hot).select(F.col("dst").alias("v"), (F.col("dist") + 1).alias("dist"))
    return moved.unionByName(state.select("v", "dist"))
