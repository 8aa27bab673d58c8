"""PageRank with the rank of vertices without out-edges shared among all vertices."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.operators.skew import ROWS_PER_TASK
from emberline.plans.graph_layout import EdgeLayout
from emberline.plans.snapshots import Snapshots
from emberline.session import cut_lineage
from emberline.sources.bucketed import sorted_buckets
from emberline.sources.graphs import chain_graph

ROUNDS = 10


@dataclass
class Ranks:
    ranks: DataFrame
    """`(v, pr)`"""
    masses: list[float]
    """Total rank after each round."""


def pagerank(
    edges: DataFrame,
    damping: float = 1.0,
    rounds: int = ROUNDS,
    rows_per_task: int = ROWS_PER_TASK,
    snapshots: str | None = None,
    resume: bool = False,
) -> Ranks:
    """A fixed number of rounds from equal ranks. A repeated edge carries a share per copy.

    Per round the edges stay partitioned by source; the rank table moves to them, and the contributions,
    summed per task, move to their targets. One row with the total and the dangling rank comes back. With `snapshots`, round
    i's ranks are also written below that path as `iter=i`; with `resume` the run goes on behind the last round written there.
    """
    spark = edges.sparkSession
    store = None if snapshots is None else Snapshots(spark, snapshots, {"loop": "pagerank", "damping": damping})
    with sorted_buckets(spark):
        layout = EdgeLayout.build(edges, rows_per_task)
        try:
            table = layout.vertices.select("v", F.col("out_edges").cast("double").alias("out_edges"))
            n, sinks = table.agg(F.count(F.lit(1)), F.count_if(F.col("out_edges") == 0)).first()
            if n == 0:
                return Ranks(table.select("v", F.lit(0.0).alias("pr")), [0.0] * rounds)
            lost = F.sum(F.when(F.col("out_edges") == 0, F.col("pr")).otherwise(0.0))
            masses: list[float] = []
            if resume and store is not None and (last := store.last()):
                state = cut_lineage(table.join(store.read(last[0]), "v"))
                masses, dangling = last[1]["masses"], state.agg(lost).first()[0]
            else:
                state, dangling = table.withColumn("pr", F.lit(1.0 / n)), sinks / n
            for i in range(len(masses) + 1, rounds + 1):
                sent = state.where("out_edges > 0").select(F.col("v").alias("src"), (F.col("pr") / F.col("out_edges")).alias("share"))
                got = (F.col("share") * F.col("n")).alias("got")
                received = layout.follow(sent).select(F.col("dst").alias("v"), got, F.lit(0.0).alias("out_edges"))
                every = received.unionByName(table.select("v", F.lit(0.0).alias("got"), "out_edges"))
                summed = every.groupBy("v").agg(F.sum("got").alias("got"), F.max("out_edges").alias("out_edges"))
                rank = F.lit((1.0 - damping) / n) + F.lit(damping) * (F.col("got") + F.lit(dangling / n))
                state = cut_lineage(summed.select("v", "out_edges", rank.alias("pr")))
                mass, dangling = state.agg(F.sum("pr"), lost).first()
                masses.append(mass)
                if store is not None:
                    store.write(i, state.select("v", "pr"), masses=masses)
        finally:
            layout.release()
    return Ranks(state.select("v", "pr"), masses)


def pagerank_chain(spark, k: int, rounds: int = ROUNDS) -> Ranks:
    """Ranks on the chain graph. Vertex 0 only collects what the chain ends pass on, and keeps rank 0."""
    return pagerank_chains(chain_graph(spark, k), rounds)


def pagerank_chains(chains: DataFrame, rounds: int = ROUNDS) -> Ranks:
    """Ranks on chains that end in vertex 0, which is no vertex of theirs and keeps rank 0."""
    spark = chains.sparkSession
    result = pagerank(chains.where(F.col("dst") != 0), rounds=rounds)
    zero = spark.range(1).select(F.col("id").alias("v"), F.lit(0.0).alias("pr"))
    return Ranks(result.ranks.unionByName(zero), result.masses)


def mass_table(spark, masses: list[float]) -> DataFrame:
    """One row per round, for a list as long as the number of rounds."""
    return spark.createDataFrame(list(enumerate(masses, start=1)), "round int, mass double")


def top_ranks(ranks: DataFrame, n: int = 5, digits: int = 10) -> DataFrame:
    """The n vertices of highest rank; equal ranks (after rounding) by vertex."""
    return ranks.select("v", F.round("pr", digits).alias("pr")).orderBy(F.desc("pr"), "v").limit(n)
