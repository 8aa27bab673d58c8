"""Smallest distinct distances per key, and voting among them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HELD_ROWS = 1_000_000


def least_of_batches(batches: Iterator[pa.RecordBatch], k: int, held_rows: int = HELD_ROWS) -> Iterator[pa.RecordBatch]:
    """A task's rows `(id, d, cls)` cut to the k least distances of each id, each with its least class.

    The table in hand has at most k rows per id; beyond `held_rows` rows (very many ids) it is sent on and begun anew.
    """
    held: list[pa.Table] = []
    new = 0

    def cut() -> pa.Table:
        least = pa.concat_tables(held).group_by(["id", "d"]).aggregate([("cls", "min")]).select(["id", "d", "cls_min"]).rename_columns(["id", "d", "cls"])
        least = least.sort_by([("id", "ascending"), ("d", "ascending")])
        id_code = pc.rank(least.column("id"), tiebreaker="dense", null_placement="at_end").to_numpy()
        place = np.arange(len(id_code)) - np.searchsorted(id_code, id_code)
        return least.filter(pa.array(place < k))

    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        new += batch.num_rows
        if new > held_rows // 2:
            held, new = [cut()], 0
            if len(held[0]) > held_rows:
                yield from held.pop().to_batches()
    if held:
        yield from cut().to_batches()


def k_smallest(pairs: DataFrame, k: int) -> DataFrame:
    """Per `id`, the k smallest distinct values of `d`, each with its least `cls`.

    A task merges equal distances and sends at most k rows of an id into the only shuffle (by `id`), however many
    rows share a distance. Rows without an id or a distance order last, as in `sort`.
    """
    rows = pairs.select("id", "d", "cls")
    kinds = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    least = rows.mapInArrow(lambda batches: least_of_batches(batches, k), kinds)
    by_distance = Window.partitionBy("id").orderBy(F.asc_nulls_last("d"))
    near = least.withColumn("rank", F.dense_rank().over(by_distance)).where(F.col("rank") <= k)
    return near.groupBy("id", "d", "rank").agg(F.min("cls").alias("cls")).select("id", "d", "cls", "rank")


def k_smallest_in_array(column: str, k: int) -> Column:
    """The same for a column that holds an array of `(d, cls)` entries.

    The one-element array binds the sorted entries, so that they are sorted once per row.
    """
    first_of_distance = "filter(o, (e, i) -> i = 0 or e.d <> get(o, i - 1).d)"
    return F.expr(f"slice(transform(array(sort_array({column})), o -> {first_of_distance})[0], 1, {k})")


def majority(column: str) -> Column:
    """Most frequent element of an array of numbers; the least one wins a tie."""
    votes = f"transform(array_distinct({column}), c -> struct(size(filter({column}, x -> x = c)) as votes, -c as least))"
    return F.expr(f"-array_max({votes}).least")


def majority_vote(votes: DataFrame) -> DataFrame:
    """`(id, cls)` rows to `(id, pred)`; counts are combined before the shuffle, the least class wins a tie."""
    counts = votes.groupBy("id", "cls").agg(F.count(F.lit(1)).alias("votes"))
    best = F.max(F.struct("votes", (-F.col("cls")).alias("least")))
    return counts.groupBy("id").agg((-best["least"]).alias("pred"))
