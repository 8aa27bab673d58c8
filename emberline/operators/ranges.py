"""Order-dependent operators over ranges of rows, so that no task sees the whole order.

A table is cut into ranges by Spark's range partitioning and stored; the ranges are numbered by the partition they were written
from, so nothing about the cuts comes to the driver. What crosses a cut is carried in tables of a few rows per range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.session import cut_lineage, shuffle_width

ROWS_PER_RANGE = 250_000
SMALL_RANGE = 4_096


def in_ranges(df: DataFrame, order: Sequence[str], rows_per_range: int | None = None, rows: int | None = None) -> DataFrame:
    """The rows stored in ranges of `order`, with the number of their range in `_part`.

    With `rows_per_range` ranges hold about as many; without it their number is that of a shuffle. `rows` is the number
    of rows or a bound of it; if it is not given but needed, the rows are stored and counted first. `order` must tell
    rows apart where many could be equal: equal ones share a range.
    """
    if rows_per_range is None:
        ranged = df.repartitionByRange(*order)
    else:
        kept = cut_lineage(df) if rows is None else df
        rows = kept.count() if rows is None else rows
        few = min(shuffle_width(df.sparkSession), -(-rows // SMALL_RANGE))  # a small table still takes all cores
        ranged = kept.repartitionByRange(max(1, few, -(-rows // rows_per_range)), *order)
    return cut_lineage(ranged.withColumn("_part", F.spark_partition_id()))


def _told_apart(df: DataFrame, unique: bool) -> DataFrame:
    """Rows with a number in `_tie`, by which equal keys spread over ranges. Stored, as the numbers must not change."""
    return df.withColumn("_tie", F.lit(0)) if unique else cut_lineage(df.withColumn("_tie", F.monotonically_increasing_id()))


def running_totals(
    df: DataFrame, order: str, totals: Mapping[str, Column], rows_per_range: int | None = None, unique: bool = False
) -> DataFrame:
    """Add, per entry of `totals`, its sum over all rows before the current one in `order`.

    `order` is a column of any type that can be sorted; rows of one key follow each other in any order, and may lie in
    several ranges (`unique` promises that there are none such). Sums run inside ranges; each range then adds the sums of the
    ranges below it, a table of one row per range.
    """
    parts = in_ranges(_told_apart(df, unique), [order, "_tie"], rows_per_range)
    inside = Window.partitionBy("_part").orderBy(order, "_tie").rowsBetween(Window.unboundedPreceding, -1)
    local = parts.select("*", *[F.coalesce(F.sum(expr).over(inside), F.lit(0)).alias(name) for name, expr in totals.items()])
    below = Window.partitionBy("one").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy("_part").agg(*[F.sum(expr).alias(f"_{name}") for name, expr in totals.items()])
    offsets = sizes.withColumn("one", F.lit(1)).select(
        "_part", *[F.coalesce(F.sum(f"_{name}").over(below), F.lit(0)).alias(f"_{name}") for name in totals]
    )
    joined = local.join(offsets, "_part")
    for name in totals:
        joined = joined.withColumn(name, F.col(name) + F.col(f"_{name}"))
    return joined.drop("_part", "_tie", *[f"_{name}" for name in totals])


def assign_ids(df: DataFrame, order: str, start: int = 10_000, rows_per_range: int | None = None) -> DataFrame:
    """Consecutive ids `start + 1, start + 2, ...` in the order of a column of any type; equal keys in any order."""
    numbered = running_totals(df, order, {"id": F.lit(1).cast("bigint")}, rows_per_range)
    return numbered.withColumn("id", (F.col("id") + F.lit(start + 1)).cast("bigint"))


def places_in_groups(
    df: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "place", rows_per_range: int | None = ROWS_PER_RANGE, rows: int | None = None
) -> DataFrame:
    """Add the place from 0 of each row among the rows of its `group`, in `order`; no two rows may be equal in both. `rows` as for
    `in_ranges`.

    A group may lie in many ranges. Only the first group of a range can have rows below it, and those lie in ranges that end in the
    same group, so a table of one row per range says how many there are.
    """
    parts = in_ranges(df, [*group, *order], rows_per_range, rows)
    sizes = parts.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("n"))
    key = F.struct(*group)
    ends = cut_lineage(sizes.groupBy("_part").agg(F.min(key).alias("first"), F.max(F.struct(key.alias("key"), "n")).alias("last")))
    asked = ends.select("_part", F.col("first").alias("key"), F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("asks"))
    told = ends.select("_part", "last.key", "last.n", F.lit(False).alias("asks"))
    below = Window.partitionBy("key").orderBy("_part").rangeBetween(Window.unboundedPreceding, -1)
    offsets = asked.unionByName(told).withColumn("before", F.coalesce(F.sum("n").over(below), F.lit(0))).where("asks and before > 0")
    inside = Window.partitionBy("_part", *group).orderBy(*order)
    joined = parts.join(offsets.select("_part", F.col("key").alias("_first"), "before"), "_part", "left")
    carried = F.when(key.eqNullSafe(F.col("_first")), F.col("before")).otherwise(0)
    return joined.withColumn(out, F.row_number().over(inside) - 1 + F.coalesce(carried, F.lit(0))).drop("_part", "_first", "before")
