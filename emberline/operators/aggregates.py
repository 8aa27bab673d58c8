"""Keyed and global aggregates. All combine inside the map tasks before the shuffle."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.operators.ranges import places_in_groups


def follower_count(edges: DataFrame) -> DataFrame:
    """Followers per followed vertex: `(dst, followers)`."""
    return edges.groupBy("dst").agg(F.count(F.lit(1)).alias("followers"))


def reduce_by_key(df: DataFrame, key: str, value: str, combine: Callable[[Column], Column] = F.sum) -> DataFrame:
    """Reduce the values of each key with an aggregate such as `F.sum`, `F.min` or `F.max`."""
    return df.groupBy(key).agg(combine(F.col(value)).alias(value))


def fold_by_key(df: DataFrame, key: str, value: str, zero: int | float = 0) -> DataFrame:
    """Sum per key starting from `zero`, which counts once per key whatever the partitioning."""
    return df.groupBy(key).agg((F.sum(value) + F.lit(zero)).alias(value))


def aggregate_by_key(df: DataFrame, key: str, results: Mapping[str, Column]) -> DataFrame:
    """Several aggregates of one key in one pass."""
    return df.groupBy(key).agg(*[expr.alias(name) for name, expr in results.items()])


def group_values_sum(df: DataFrame, key: str, value: str) -> DataFrame:
    """Group the values of each key, then sum the group.

    A group is held as its distinct values with their counts, so that a hot key is spread over
    tasks by value first and no task holds its full list.
    """
    groups = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("times"))
    return groups.groupBy(key).agg(F.sum(F.col(value) * F.col("times")).alias(value))


def min_by_key(df: DataFrame, key: str, value: str) -> DataFrame:
    return reduce_by_key(df, key, value, F.min)


def min_max(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def amount_min_max(transactions: DataFrame) -> DataFrame:
    """Least and greatest amount after cutting off the fraction."""
    whole = transactions.select(F.col("amount").cast("int").alias("amount"))
    return whole.agg(F.max("amount").alias("max_amount"), F.min("amount").alias("min_amount"))


def adjacency_list(edges: DataFrame, neighbours_per_row: int = 100_000) -> DataFrame:
    """Neighbours per vertex: `(v, part, neighbours, copies)`, both arrays sorted by neighbour.

    A repeated edge is one neighbour with its number of copies. The sorted neighbours of a vertex fill blocks of
    `neighbours_per_row`, numbered by `part` from 0; only the last block of a vertex can be shorter. Every neighbour's place
    is counted over ranges of (vertex, neighbour), so neither the block size nor a task depends on how large a hub is.
    """
    pairs = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("copies"))
    placed = places_in_groups(pairs, ["src"], ["dst"], "place")
    part = F.expr(f"cast(place div {neighbours_per_row} as int)").alias("part")
    lists = placed.groupBy("src", part).agg(F.sort_array(F.collect_list(F.struct("dst", "copies"))).alias("items"))
    return lists.select(F.col("src").alias("v"), "part", F.col("items.dst").alias("neighbours"), F.col("items.copies").alias("copies"))
