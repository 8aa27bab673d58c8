"""Generated graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.operators.ranges import assign_ids
from emberline.session import cut_lineage


def chains_over(vertices: DataFrame, key: str, k: int) -> DataFrame:
    """Chains of k vertices laid over the rows of a table in the order of a unique key: `(src, dst)`.

    Every vertex points to the next one; the last of a chain, and the last of all, points to 0. Keys must be above 0.
    """
    if k < 2:
        raise ValueError("a chain needs k of at least 2")
    placed = cut_lineage(assign_ids(vertices.select(F.col(key).cast("bigint").alias("src")), "src", start=0))
    after = placed.select((F.col("id") - 1).alias("id"), F.col("src").alias("next"))
    last = (F.col("id") % k == 0) | F.col("next").isNull()
    return placed.join(after, "id", "left").select("src", F.when(last, F.lit(0).cast("bigint")).otherwise(F.col("next")).alias("dst"))


def chain_graph(spark: SparkSession, k: int) -> DataFrame:
    """k chains of k vertices each, numbered 1 to k*k; the last vertex of a chain points to 0."""
    if k < 2:
        raise ValueError("a chain graph needs k of at least 2")
    v = F.col("id")
    return spark.range(1, k * k + 1).select(v.alias("src"), F.when(v % k == 0, F.lit(0)).otherwise(v + 1).cast("bigint").alias("dst"))
