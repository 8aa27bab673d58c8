"""The edge table laid out once for a loop that joins it by `src` in every round."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.operators.edges import weighted_edges
from emberline.operators.skew import ROWS_PER_TASK, copy_to_parts, hot_from_counts, spread
from emberline.session import cut_lineage, shuffle_width
from emberline.sources.bucketed import BucketedTable


@dataclass
class EdgeLayout:
    """Distinct edges `(src, dst, n)` in a table bucketed and sorted by `src`, and the table of all vertices.

    A vertex with more than `rows_per_task` distinct targets is spread over several parts, so a hub
    does not fall to one task. Inside `sorted_buckets` a round joins the edges without moving or sorting them; a lost
    executor takes nothing of them away.
    """

    table: BucketedTable
    vertices: DataFrame
    """`(v, out_edges, targets)`; both are 0 for a vertex without out-edges."""
    hot: DataFrame | None
    buckets: int

    @classmethod
    def build(cls, edges: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> EdgeLayout:
        known = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
        counted = cut_lineage(weighted_edges(known))
        one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
        ends = F.array(
            F.struct(F.col("src").alias("v"), F.col("n").alias("out_edges"), one.alias("targets")),
            F.struct(F.col("dst").alias("v"), none.alias("out_edges"), none.alias("targets")),
        )
        totals = [F.sum(c).alias(c) for c in ("out_edges", "targets")]
        vertices = cut_lineage(counted.select(F.inline(ends)).groupBy("v").agg(*totals))
        hot = hot_from_counts(vertices.withColumnRenamed("v", "src"), ["src"], "targets", rows_per_task)
        buckets = max(shuffle_width(edges.sparkSession), -(-counted.count() // rows_per_task))
        if hot is None:
            table = BucketedTable.write(counted, ["src"], buckets)
        else:
            table = BucketedTable.write(spread(counted, ["src"], hot, ["dst"]), ["src", "part"], buckets)
        return cls(table, vertices, hot, buckets)

    def follow(self, states: DataFrame) -> DataFrame:
        """`states (src, ...)` joined to the edges that leave each vertex; the edges stay where they are."""
        if self.hot is None:
            return self.table.rows.join(states, "src")
        return self.table.rows.join(copy_to_parts(states, ["src"], self.hot), ["src", "part"]).drop("part")

    def release(self) -> None:
        self.table.forget()
