"""Unweighted shortest paths from one source, round by round to the fixpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.operators.aggregates import min_by_key
from emberline.operators.skew import ROWS_PER_TASK
from emberline.plans.graph_layout import EdgeLayout
from emberline.plans.snapshots import Snapshots
from emberline.sources.bucketed import BucketedTable, sorted_buckets

LAYERS_PER_MERGE = 8


class Reached:
    """The vertices met so far, in bucketed tables sorted by `v` that stay where they are.

    Each round adds a layer. `LAYERS_PER_MERGE` layers of one size class become one of the next, so that there are few layers and a
    vertex is rewritten once per class.
    """

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.layers: list[tuple[int, BucketedTable]] = []
        self.written: list[BucketedTable] = []

    def _write(self, rows: DataFrame) -> BucketedTable:
        self.written.append(BucketedTable.write(rows, ["v"], self.buckets))
        return self.written[-1]

    def add(self, rows: DataFrame) -> BucketedTable:
        """Store the rows as a layer, unless there are none."""
        table = self._write(rows)
        if table.is_empty():
            return table
        self.layers.append((0, table))
        while len(last := self.layers[-LAYERS_PER_MERGE:]) == LAYERS_PER_MERGE and len({level for level, _ in last}) == 1:
            merged = last[0][1].rows
            for _, other in last[1:]:
                merged = merged.unionByName(other.rows)
            self.layers[-LAYERS_PER_MERGE:] = [(last[0][0] + 1, self._write(merged))]
        return table

    def without(self, met: DataFrame) -> DataFrame:
        """The rows of `met` whose `v` no layer holds; only `met` moves."""
        for _, layer in self.layers:
            met = met.join(layer.rows.select("v").hint("merge"), "v", "left_anti")  # both sides lie sorted
        return met

    def rows(self) -> DataFrame:
        every = self.layers[0][1].plain()
        for _, layer in self.layers[1:]:
            every = every.unionByName(layer.plain())
        return every

    def forget(self) -> None:
        for table in self.written:
            table.forget()


def sssp(
    edges: DataFrame,
    source: int,
    include_unreached: bool = False,
    max_rounds: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    snapshots: str | None = None,
    resume: bool = False,
) -> DataFrame:
    """`(v, dist)` for every vertex reached from `source`; unreached ones on request, with null.

    Only vertices reached in the last round send messages. With `snapshots`, round i's newly reached
    vertices are also written below that path as `iter=i`; with `resume` the run goes on behind the last round written
    there. With `max_rounds` a column `finished` tells whether that many rounds, written ones included, were enough; if not, vertices
    farther away are missing or null.
    """
    spark = edges.sparkSession
    store = None if snapshots is None else Snapshots(spark, snapshots, {"loop": "sssp", "source": source})
    rounds, finished = 0, False
    frontier = spark.range(1).select(F.lit(source).cast("bigint").alias("v"), F.lit(0).alias("dist"))
    with sorted_buckets(spark):
        layout = EdgeLayout.build(edges, rows_per_task)
        reached = Reached(layout.buckets)
        try:
            if resume and store is not None and (last := store.last()):
                rounds = last[0]
                reached.add(frontier.unionByName(store.up_to(rounds).select("v", "dist")))
                frontier = store.read(rounds)
            else:
                frontier = reached.add(frontier).rows
            while max_rounds is None or rounds < max_rounds:
                sent = layout.follow(frontier.withColumnRenamed("v", "src"))
                met = min_by_key(sent.select(F.col("dst").alias("v"), (F.col("dist") + 1).alias("dist")), "v", "dist")
                met = reached.add(reached.without(met))
                rounds += 1
                if met.is_empty():
                    finished = True
                    break
                frontier = met.rows
                if store is not None:
                    store.write(rounds, frontier)
        finally:
            layout.release()
            reached.forget()
    found = reached.rows()
    if include_unreached:
        everyone = layout.vertices.select("v").unionByName(found.select("v")).distinct()
        found = everyone.join(found, "v", "left")
    return found if max_rounds is None else found.withColumn("finished", F.lit(finished))


def longest_shortest_path(distances: DataFrame) -> DataFrame:
    """The greatest finite distance, as one row `(longest)`."""
    return distances.where(F.col("dist").isNotNull()).agg(F.max("dist").alias("longest"))
