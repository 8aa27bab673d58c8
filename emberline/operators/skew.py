"""Joins that stay balanced when one key holds a large share of the rows.

A key with more than `rows_per_task` rows is split into parts. The side that holds the
hot key spreads its rows over the parts by a hash of other columns; the matching rows of the other
side are copied once per part. Every pair of matching rows still meets exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000
HOT_KEY_LIMIT = 100_000


def hot_from_counts(
    counts: DataFrame, keys: Sequence[str], size: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame | None:
    """Keys of `counts` whose `size` is over the limit, with the number of parts each needs; None when there are none.

    The limit is `rows_per_task`, or the share 1 / HOT_KEY_LIMIT of all rows if that is more. No more than
    HOT_KEY_LIMIT keys can be over it, so the list always fits a broadcast; a key below it is small
    beside an even share of the rows.
    """
    total = counts.agg(F.sum(size).alias("total")).first()["total"] or 0
    limit = max(rows_per_task, total // HOT_KEY_LIMIT)
    hot = counts.where(F.col(size) > limit).select(*keys, F.ceil(F.col(size) / F.lit(limit)).cast("int").alias("parts"))
    found = hot.collect()
    return F.broadcast(counts.sparkSession.createDataFrame(found, hot.schema)) if found else None


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame | None:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
    return hot_from_counts(counts, keys, "size", rows_per_task)


def spread(df: DataFrame, keys: Sequence[str], hot: DataFrame | None, by: Sequence[str], part: str = "part") -> DataFrame:
    """Give each row one part of its key, chosen by a hash of the `by` columns."""
    if hot is None:
        return df.withColumn(part, F.lit(0))
    hashed = F.pmod(F.xxhash64(*by), F.coalesce(F.col("parts"), F.lit(1)).cast("bigint")).cast("int")
    return df.join(hot, list(keys), "left").withColumn(part, hashed).drop("parts")


def copy_to_parts(df: DataFrame, keys: Sequence[str], hot: DataFrame | None, part: str = "part") -> DataFrame:
    """Repeat each row once for every part of its key."""
    if hot is None:
        return df.withColumn(part, F.lit(0))
    parts = F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1)
    return df.join(hot, list(keys), "left").withColumn(part, F.explode(parts)).drop("parts")


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    by: Sequence[str],
    hot: DataFrame | None,
    condition: Column | None = None,
) -> DataFrame:
    """Inner join in which `left` may hold the hot keys listed in `hot`."""
    keys = list(keys)
    if hot is None:
        joined = left.join(right, keys)
    else:
        joined = spread(left, keys, hot, by).join(copy_to_parts(right, keys, hot), [*keys, "part"]).drop("part")
    return joined if condition is None else joined.where(condition)


def grid_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_by: Sequence[str],
    right_by: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Inner join in which the same key may be hot on both sides: its rows meet on a grid of parts."""
    left_hot = hot_keys(left, [key], rows_per_task)
    right_hot = hot_keys(right, [key], rows_per_task)
    if left_hot is None and right_hot is None:
        return left.join(right, key)
    left = copy_to_parts(spread(left, [key], left_hot, left_by, "row_part"), [key], right_hot, "col_part")
    right = copy_to_parts(spread(right, [key], right_hot, right_by, "col_part"), [key], left_hot, "row_part")
    return left.join(right, [key, "row_part", "col_part"]).drop("row_part", "col_part")
